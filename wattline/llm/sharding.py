"""Sharding by global byte-size prefix sums.

The rows are put in a total order (document id, then size, checksum and a tie-break), cut by range
into slices of about equal row counts, and written once with their slice, so slices stay fixed.  The
total of each slice gives its global offset (one row per slice, a running sum over as many rows as
there are slices); inside its slice each row adds its own running sum.  A row's shard is the
equal-target interval that holds the middle of its bytes, so shards are contiguous in the order and
differ from the mean by less than one document on each side.

No step sees more than one slice: the running sums are windows over a slice, and a slice is a range
of the sorted order.  Rows that are equal in every key are told apart by a running row id, so copies
of one row never make a slice that can't be cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattline.llm.common import written


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none) plus 1 for its end."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def prefix_sums(rows: DataFrame, order: list[str], size: str, slices: int | None = None) -> DataFrame:
    """Add ``_row`` (0-based place in the order) and ``_before`` (bytes of all rows before).

    ``rows`` must not hold columns named ``_tie``, ``_slice``, ``_row`` or ``_before``.  An empty
    table gives an empty result.  ``slices`` defaults to ``spark.sql.shuffle.partitions``.
    """
    n = slices or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_last() for c in order] + [F.col("_tie")]
    ranged = (rows.withColumn("_tie", F.monotonically_increasing_id())
              .repartitionByRange(n, *keys)
              .withColumn("_slice", F.spark_partition_id()))
    fixed = written(ranged, "sharding-slices")
    totals = fixed.groupBy("_slice").agg(F.sum(size).alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_slice",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes0"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows0"))
    inside = Window.partitionBy("_slice").orderBy(*keys)
    # one row per slice: at most n rows, a bound set by the session and not by the data
    return (fixed.join(F.broadcast(offsets), "_slice")
            .withColumn("_row", F.col("_rows0") + F.row_number().over(inside) - 1)
            .withColumn("_before", F.col("_bytes0") + F.sum(size).over(
                inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col(size))
            .drop("_tie", "_slice", "_bytes0", "_rows0"))


def shard_by_bytes(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Assign every row of ``docs`` to one of ``shards`` contiguous shards of about equal bytes.

    Returns id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` (gapless from 0 within its
    shard, in order) and ``grown_shard`` (null under this law).  Null texts have size 1 and the
    checksum of no bytes; null ids come last; repeated rows are placed one by one; an empty table
    gives no rows.  Other columns of ``docs`` aren't read.
    """
    rows = docs.select(
        F.col(id_col).alias(id_col),
        text_size(F.col(text_col)).alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"))
    placed = prefix_sums(rows, [id_col, "size", "text_crc32"], "size")
    placed = written(placed, "sharding-placed")
    total = placed.agg(F.sum("size").alias("_total"))
    middle = F.col("_before") * 2 + F.col("size")  # twice the middle, so that it stays whole
    cut = F.floor(middle.cast("decimal(38,0)") * shards / (F.col("_total").cast("decimal(38,0)") * 2))
    sharded = (placed.crossJoin(F.broadcast(total))  # one row
               .withColumn("shard", F.least(cut.cast("int"), F.lit(shards - 1))))
    first = sharded.groupBy("shard").agg(F.min("_row").alias("_first"))
    return (sharded.join(F.broadcast(first), "shard")  # one row per shard
            .select(F.col(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("_row") - F.col("_first")).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
