"""Bronze / dead-letter / Gold sinks and physical layout.

Format is a parameter (Parquet here; Delta where its package is installed).  Series tables are
partitioned by ``event_date`` and clustered by ``node_id`` inside the files (the declared layout is
node and day; see ``_layout`` for why node is a clustering key here); plants and the dead-letter
table are not partitioned.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline import schemas
from wattline.operators import decode as DC
from wattline.session import materialized

SERIES_PARTITIONS = ["event_date"]
CLUSTER = ["node_id", "timestamp"]


def partition_cols(table: str) -> list[str]:
    return [] if table in ("plants", "dead_letter_queue") else SERIES_PARTITIONS


def _layout(df: DataFrame, table: str):
    """Series rows are range-partitioned on (day, node, time) — a hot day, or a hot node inside a
    day, is split across tasks by node and time range — and sorted by node and time inside each
    file, so node predicates skip row groups.  Directories are per day only: a directory per node
    would multiply the file count by the node count, which grows with the data.  Micro-batches
    are laid out the same way: hashing them by day alone would put a hot day in one task."""
    parts = partition_cols(table)
    if not parts:
        return df, parts
    spread = df.repartitionByRange(*parts, *CLUSTER)
    return spread.sortWithinPartitions(*parts, *CLUSTER), parts


def append_table(df: DataFrame, root: str, table: str, fmt: str = "parquet") -> str:
    """Append one table's rows, partitioned by day and clustered by node."""
    path = f"{root}/{table}"
    laid, parts = _layout(df, table)
    w = laid.write.mode("append").format(fmt)
    if parts:
        w = w.partitionBy(*parts)
    w.save(path)
    return path


def write_epoch(df: DataFrame, root: str, table: str, epoch: int | str, fmt: str = "parquet") -> str:
    """Exactly-once write of one batch: it goes to ``<table>/batch=<epoch>`` with overwrite, so a
    retried epoch replaces its own output instead of appending it twice."""
    path = f"{root}/{table}/batch={epoch}"
    laid, parts = _layout(df, table)
    w = laid.write.mode("overwrite").format(fmt)
    if parts:
        w = w.partitionBy(*parts)
    w.save(path)
    return path


LEDGER = "landed_ranges"
#: Marks of epochs whose snapshot is gone.
CLOSED = "_closed"
#: Offsets of one ledger bucket: ranges don't cross buckets, so they are merged bucket by bucket.
LEDGER_SPAN = 1 << 20
RANGES = "topic string, partition int, bucket bigint, lo bigint, hi bigint, kind string"
#: Offsets of one block of a lookup in the ledger.
LOOKUP_SPAN = 256
_PLACE = ["topic", "partition", "bucket"]
KEYS = ["topic", "partition", "offset"]


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def _snapshots(spark: SparkSession, root: str) -> dict[str, int]:
    """Ledger snapshots that stand complete: epoch -> number."""
    fs, at = _fs(spark, f"{root}/{LEDGER}")
    if not fs.exists(at):
        return {}
    names = [f.getPath().getName() for f in fs.listStatus(at) if fs.exists(_fs(spark, f"{f.getPath()}/_SUCCESS")[1])]
    return {epoch: int(n) for n, _, epoch in (x.partition("-") for x in names)}


def _snapshot(spark: SparkSession, root: str, n: int, epoch: str) -> DataFrame:
    return spark.read.schema(RANGES).parquet(f"{root}/{LEDGER}/{n:08d}-{epoch}")


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """Ranges of offsets taken so far, per topic, partition and kind: ``taken`` (landed or rejected when they
    first came) and ``redriven`` (dead letters that have landed since).  Its size follows the gaps between
    the offsets, not the messages: a partition read without gaps has one row for each ``LEDGER_SPAN`` offsets."""
    done = _snapshots(spark, root)
    if not done:
        return spark.createDataFrame([], RANGES)
    epoch = max(done, key=done.get)
    return _snapshot(spark, root, done[epoch], epoch)


def merged(ranges: DataFrame) -> DataFrame:
    """Ranges with those that touch or overlap made one, inside each bucket (LEDGER_SPAN offsets at most)."""
    w = Window.partitionBy(*_PLACE, "kind").orderBy("lo", "hi")
    before = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(before.isNull() | (F.col("lo") > before + 1), 1).otherwise(0)
    runs = ranges.withColumn("_s", starts).withColumn("_run", F.sum("_s").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return runs.groupBy(*_PLACE, "kind", "_run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select(
        *_PLACE, "lo", "hi", "kind")


def _bucket() -> Column:
    return F.floor(F.col("offset") / LEDGER_SPAN).cast("bigint")


def offset_ranges(rows: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """Ranges of the offsets of ``rows``, and the buckets in which a message stands more than once.

    Buckets without gaps are known by their counts; only the offsets of the others are put in order."""
    once = rows.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("_n"))
    per = materialized(once.groupBy("topic", "partition", _bucket().alias("bucket")).agg(
        F.min("offset").alias("lo"), F.max("offset").alias("hi"), F.count(F.lit(1)).alias("n"), F.sum("_n").alias("rows")), "ranges")
    full = F.col("n") == F.col("hi") - F.col("lo") + 1
    ranges = per.filter(full).select(*_PLACE, "lo", "hi", F.lit(kind).alias("kind"))
    gappy = per.filter(~full).select(*_PLACE)
    if gappy.take(1):
        loose = rows.select("topic", "partition", _bucket().alias("bucket"), "offset").join(gappy, _PLACE, "left_semi").distinct()
        ranges = ranges.unionByName(merged(loose.select(*_PLACE, F.col("offset").alias("lo"), F.col("offset").alias("hi"),
                                                        F.lit(kind).alias("kind"))))
    return ranges, per.filter("rows > n").select(*_PLACE)


def not_taken(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows whose offset lies in none of ``ranges``.

    Redriven dead letters leave nearly as many ranges as messages in a bucket.  Those shorter than ``LOOKUP_SPAN``
    are met by blocks of that many offsets, which hold few of them; only the others, few in a bucket, by bucket."""
    def block(c: str) -> Column:
        return F.floor(F.col(c) / LOOKUP_SPAN).cast("bigint")
    short = F.col("hi") - F.col("lo") < LOOKUP_SPAN
    cut = ranges.filter(short).withColumn("bucket", F.explode(F.array_distinct(F.array(block("lo"), block("hi")))))
    for part, at in ((cut, block("offset")), (ranges.filter(~short), _bucket())):
        old = part.select(*[F.col(c).alias(f"_{c}") for c in (*_PLACE, "lo", "hi")])
        inside = [F.col(c) == F.col(f"_{c}") for c in _PLACE] + [F.col("offset").between(F.col("_lo"), F.col("_hi"))]
        rows = rows.withColumn("bucket", at).join(old, inside, "left_anti")
    return rows


def _second_copies(rows: DataFrame, where: DataFrame) -> DataFrame:
    """``_row`` of every message that stands before its own second copy in the batch: of equal offsets the
    one with the earliest broker time stays, then the smallest content."""
    order = F.struct(*[c for c in ("timestamp", "_hash", "_row") if c in rows.columns])
    near = rows.withColumn("bucket", _bucket()).join(where, _PLACE, "left_semi").select(*KEYS, "_row", order.alias("_order"))
    first = near.groupBy(*KEYS).agg(F.min("_order").alias("_first"))
    return near.join(first, KEYS).filter(F.col("_order") != F.col("_first")).select("_row")


#: Columns that senders have added to a table: one row each.
COLUMNS = "_columns"
_COLUMNS = "table_name string, name string, type string, since string"


def added_columns(spark: SparkSession, root: str) -> dict[str, dict[str, str]]:
    """Table -> (column -> type) of the columns registered so far."""
    out: dict[str, dict[str, str]] = {}
    if exists(spark, f"{root}/{COLUMNS}"):
        for r in spark.read.schema(_COLUMNS).parquet(f"{root}/{COLUMNS}").orderBy("table_name", "name").collect():
            out.setdefault(r.table_name, {}).setdefault(r.name, r.type)
    return out


def register_columns(staged: DataFrame, root: str, epoch: str) -> dict[str, dict[str, str]]:
    """Payload keys of landed rows that no table column holds become columns, from this batch on.

    A key is registered if it is a plain lower-case name; as a double if all its values in the batch that brings
    it are numbers, else as a string.  Only the unknown entries of rows that have some are looked at.  The
    registry is written by epoch, so a retry finds the same columns."""
    spark = staged.sparkSession
    known = added_columns(spark, root)
    new = None
    for topic, table in schemas.TOPIC_TABLE.items():
        have = list(known.get(table, {}))

        def unknown(k, table=table, have=have):
            return ~DC.declared_field(table, k) & ~k.isin(*have, "") & k.rlike("^[a-z][a-z0-9_]{0,63}$")
        extra = staged.filter((F.col("_topic") == topic) & F.col("landed")).select(
            F.map_filter("p", lambda k, v: unknown(k)).alias("x")).filter(F.size("x") > 0)
        part = extra.select(F.explode("x").alias("name", "value")).groupBy("name").agg(
            F.count("value").alias("n"), F.count(F.col("value").try_cast("double")).alias("numbers")).select(
            F.lit(table).alias("table_name"), "name", F.when(F.col("n") == F.col("numbers"), "double").otherwise("string").alias("type"),
            F.lit(epoch).alias("since"))
        new = part if new is None else new.unionByName(part)
    rows = new.collect()                    # one row for each new column
    if rows:
        spark.createDataFrame(rows, _COLUMNS).coalesce(1).write.mode("overwrite").parquet(f"{root}/{COLUMNS}/batch={epoch}")
    return added_columns(spark, root)


def land(decoded: DataFrame, root: str, epoch: int | str, redrive: bool = False, evolve: bool = False) -> None:
    """One batch of decoded messages into the five tables and the dead-letter table.

    Messages that an earlier batch has taken (their offset lies in a range of the ledger) and second copies
    inside the batch are left out.  With ``redrive`` the batch holds dead letters sent again: they land if
    they are good now and have not landed since.  What remains is judged once and staged by topic and
    outcome, without a shuffle; every table is written from its own part of the stage.  All writes carry the
    epoch, so a retry of the last epoch replaces them; an earlier epoch that comes again is left as it is.
    The ledger is merged on write: one snapshot for each batch, the last two are kept.  With ``evolve``, fields that
    the tables lack become columns (see ``register_columns``); rows landed before read NULL there
    (``read_table`` with ``merge_schema``)."""
    spark, epoch = decoded.sparkSession, str(epoch)
    done = _snapshots(spark, root)
    n = done.pop(epoch, None)
    last = max(done.values(), default=-1)
    if (n is not None and n < last) or (n is None and exists(spark, f"{root}/{CLOSED}/{epoch}")):
        return
    n = last + 1 if n is None else n
    before = {k: e for e, k in done.items()}.get(n - 1)
    known = spark.createDataFrame([], RANGES) if before is None else _snapshot(spark, root, n - 1, before)
    kind = "redriven" if redrive else "taken"
    new = not_taken(DC.judged(decoded), known.filter(F.col("kind") == kind))
    if redrive:
        dead = read_table(spark, root, "dead_letter_queue").select(
            "topic", F.col("partition_id").alias("partition"), F.col("offset_id").alias("offset"))
        new = new.join(dead, KEYS, "left_semi")
    landed = F.col("reject").isNull()
    content = F.xxhash64("value") if "value" in decoded.columns else F.lit(0)
    staged = new.select(
        *KEYS, "key", *[c for c in ("timestamp",) if c in decoded.columns], "error_message", "reject",
        F.when(~landed, F.col("value_text")).alias("value_text"), F.when(landed, F.col("p")).alias("p"),
        content.alias("_hash"), F.monotonically_increasing_id().alias("_row"), F.col("topic").alias("_topic"), landed.alias("landed"))
    stage = f"{root}/_stage/batch={epoch}"
    staged.write.mode("overwrite").partitionBy("_topic", "landed").parquet(stage)
    staged = spark.read.schema(staged.schema).parquet(stage)
    ranges, twice = offset_ranges(staged.select(*KEYS), kind)
    if twice.take(1):
        staged = staged.join(materialized(_second_copies(staged, twice), "copies"), "_row", "left_anti")
    if redrive:         # what is rejected again may come again
        ranges, _ = offset_ranges(staged.filter("landed").select(*KEYS), kind)

    added = register_columns(staged, root, epoch) if evolve else {}

    def table_rows(topic: str, table: str) -> DataFrame:
        rows = staged.filter((F.col("_topic") == topic) & F.col("landed"))
        return DC.to_table(rows, table, F.lit(epoch), added.get(table))[0]

    writes = [lambda t=t, b=b: write_epoch(table_rows(t, b), root, b, epoch) for t, b in schemas.TOPIC_TABLE.items()]
    writes.append(lambda: write_epoch(DC.dead_letters(staged.filter(~F.col("landed")), F.lit(epoch)), root, "dead_letter_queue", epoch))
    at_once(spark, writes)
    (merged(known.unionByName(ranges)).coalesce(max(1, spark.sparkContext.defaultParallelism // 4))
     .write.mode("overwrite").parquet(f"{root}/{LEDGER}/{n:08d}-{epoch}"))
    for e, k in done.items():
        if k < n - 1:
            fs, at = _fs(spark, f"{root}/{LEDGER}/{k:08d}-{e}")
            fs.mkdirs(_fs(spark, f"{root}/{CLOSED}/{e}")[1])
            fs.delete(at, True)


def at_once(spark: SparkSession, writes: Sequence[Callable[[], object]], most: int | None = None) -> None:
    """Independent writes as concurrent jobs of one session (``most`` at a time): small tables fill the gaps of large ones."""
    with ThreadPoolExecutor(min(len(writes), most or len(writes))) as pool:
        for f in [pool.submit(inheritable_thread_target(spark)(w)) for w in writes]:
            f.result()


def taken_messages(spark: SparkSession, root: str) -> DataFrame:
    """Every message taken, one row each: topic, partition, offset, landed (false for what is still a dead letter)."""
    all_ranges = ledger(spark, root)
    offsets = F.explode(F.sequence("lo", "hi")).alias("offset")
    back = all_ranges.filter("kind = 'redriven'").select("topic", "partition", offsets)
    dead = read_table(spark, root, "dead_letter_queue").select(
        "topic", F.col("partition_id").alias("partition"), F.col("offset_id").alias("offset")).distinct().join(back, KEYS, "left_anti")
    return (all_ranges.filter("kind = 'taken'").select("topic", "partition", offsets)
            .join(dead.withColumn("_dead", F.lit(True)), KEYS, "left").select(*KEYS, F.col("_dead").isNull().alias("landed")))


#: One metric of each table, for queries over all of them.
METRIC = {"scada_telemetry": "solar_mw", "weather": "temperature_c", "demand": "demand_mw",
          "grid_dispatch": "total_generation_mw", "plants": "capacity_mw"}


def all_tables(spark: SparkSession, root: str) -> DataFrame:
    """The five tables in one shape: table, entity (plant or node), day, metric, dataset, batch."""
    out = None
    for table, metric in METRIC.items():
        plant = table == "plants"
        t = read_table(spark, root, table).select(
            F.lit(table).alias("table_name"), F.col("plant_id" if plant else "node_id").alias("entity"),
            (F.lit(None) if plant else F.col("event_date")).cast("date").alias("event_date"),
            F.col(metric).alias("metric"), "_dataset")
        out = t if out is None else out.unionByName(t)
    return out


def read_table(spark: SparkSession, root: str, table: str, fmt: str = "parquet",
               merge_schema: bool = False) -> DataFrame:
    r = spark.read.format(fmt)
    if merge_schema:
        r = r.option("mergeSchema", "true")
    return r.load(f"{root}/{table}")


def clustered_write(df: DataFrame, path: str, keys: Sequence[str], size: int, target_file_bytes: int = 256 << 20) -> str:
    """Range-partition on the clustering keys and sort inside each file, so every file (and
    row group) covers a narrow key range and min/max statistics let readers skip it.  ``size`` (bytes of
    the source) decides the number of files."""
    files = max(1, -(-size // target_file_bytes))
    (df.repartitionByRange(files, *keys).sortWithinPartitions(*keys)
     .write.mode("overwrite").parquet(path))
    return path


def _period(value: str) -> tuple[dt.date, dt.date]:
    """First and last day of a year (2024), month (2024-01) or day (2024-01-31)."""
    y, m, d = (*(int(x) for x in value.split("-")), None, None)[:3]
    first = dt.date(y, m or 1, d or 1)
    after = dt.date(y + 1, 1, 1) if m is None else dt.date(y + m // 12, m % 12 + 1, 1) if d is None else first + dt.timedelta(1)
    return first, after - dt.timedelta(1)


def retain(spark: SparkSession, path: str, partition: str, ts: str, as_of: str, months: int) -> None:
    """S18 on a stored table partitioned by year, month or day: drop the directories of periods that end before
    the limit, rewrite the one that the limit falls into (staged, then dynamic partition overwrite) unless
    it starts there, leave the rest.  Directories with other values (the default partition) stay."""
    limit = spark.range(1).select(F.add_months(F.to_date(F.lit(as_of)), -months)).first()[0]
    fs, at = _fs(spark, path)
    for d in fs.listStatus(at):
        name, _, value = d.getPath().getName().partition("=")
        if name != partition or not value.replace("-", "").isdigit():
            continue
        first, last = _period(value)
        if last < limit:
            fs.delete(d.getPath(), True)
        elif first < limit:
            edge = spark.read.parquet(path).filter(F.col(partition).cast("string") == value)
            kept = materialized(edge.filter(F.to_date(ts) >= F.lit(limit)), "retained")
            if kept.take(1):
                materialize(kept, path, [partition])
            else:
                fs.delete(d.getPath(), True)


def materialize(df: DataFrame, path: str, partition_by: Sequence[str]) -> str:
    """Dynamic partition overwrite: a re-run replaces only the partitions it produces."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))
    return path


def read_seed_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Header CSV with every column read as STRING; a missing path gives an empty frame with
    the schema (the reference warns and skips)."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).csv(path)


def write_seed_csv(df: DataFrame, path: str) -> str:
    """Header CSV, columns in the frame's order."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path
