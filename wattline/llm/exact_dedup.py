"""Exact deduplication as a stateful stream.

1. Each row becomes a small record of an arrival log: digest (SHA-256 of the normalised text), id,
   content locator.  The log is a table in the shared folder.
2. A Structured Streaming query reads the log in several micro-batches (by bytes).  Its keyed state
   (RocksDB on disk, checkpointed to the shared folder, no watermark and so no expiry) keeps for each
   digest the smallest id with its locator and the number of arrivals; later micro-batches, and later
   runs on the same state, hit what earlier ones have kept.
3. Hits (digests that arrived more than once) are checked on the full bytes, which are fetched through the
   locators of their arrivals: for each digest the smallest and the largest normalised text must be the
   same.  The locators are broadcast while they are few (checked), so only the texts of hits are shuffled, and
   combined in each task first: a group of copies sends one text per task.  Different texts under
   one digest, which nobody has seen yet, would be regrouped by the text itself.

Only DataFrame and SQL functions touch rows; the one Python call is the driver's ``foreachBatch``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm.common import SPACES, free_name, scratch, written
from wattline.operators.joins import broadcast_if_small
from wattline.sources.bronze import exists

#: State on disk; without file preallocation, which costs megabytes for each state partition.
_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    """The text with each run of white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def _digest(text_col: str) -> Column:
    return F.unhex(F.sha2(normalised(F.col(text_col)), 256))


def with_locator(docs: DataFrame, name: str) -> DataFrame:
    """Add the locator: file and row for rows that are read from files (the same in every scan),
    else a running row number."""
    if from_files(docs):
        return docs.withColumn(name, F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")))
    return docs.withColumn(name, F.struct(F.lit("").alias("file"), F.monotonically_increasing_id().alias("row")))


def from_files(docs: DataFrame) -> bool:
    try:
        docs.select("_metadata.row_index").schema
    except AnalysisException:
        return False
    return True


def arrival_log(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Append (doc, digest, locator) of every row of ``docs`` to the log at ``path``."""
    at = free_name(docs, "_locator")
    arrivals(with_locator(docs, at), at, id_col, text_col).write.mode("append").parquet(path)


def arrivals(docs: DataFrame, at: str, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc"), _digest(text_col).alias("digest"), F.col(at).alias("locator"))


LOG = "doc bigint, digest binary, locator struct<file: string, row: bigint>"
_STATE = ("digest binary, keeper struct<no_doc: boolean, doc: bigint, locator: struct<file: string, row: bigint>>, "
          "group_size bigint")


def _keeper() -> Column:
    """Orders arrivals: the smallest id first, null ids last, ties by locator."""
    return F.struct(F.col("doc").isNull().alias("no_doc"), "doc", "locator")


#: Micro-batches that a log is cut into at least, if it is larger than ``LEAST_BATCH``; bytes of one at most.
BATCHES, LEAST_BATCH, MOST_BATCH = 4, 256 << 10, 16 << 30


def batch_bytes(spark: SparkSession, log_path: str) -> int:
    """Bytes of a micro-batch, from the size of the log."""
    at = spark._jvm.org.apache.hadoop.fs.Path(log_path)
    size = at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()
    return min(MOST_BATCH, max(LEAST_BATCH, size // BATCHES))


def drain(spark: SparkSession, log_path: str, checkpoint: str, updates: str) -> DataFrame:
    """Drain the log through the keyed state; returns one row per digest: keeper and group size.

    Every micro-batch writes the changed digests to its own folder (rewritten if the batch is run
    again).  Counts only grow and keepers only fall, so the last state of a digest has the largest
    count and the smallest keeper.
    """
    before = {k: spark.conf.get(k, None) for k in _STORE}
    for k, v in _STORE.items():
        spark.conf.set(k, v)
    try:
        counted = (spark.readStream.schema(LOG).option("maxBytesPerTrigger", batch_bytes(spark, log_path)).parquet(log_path)
                   .groupBy("digest").agg(F.min(_keeper()).alias("keeper"), F.count(F.lit(1)).alias("group_size")))

        def land(batch: DataFrame, epoch: int) -> None:
            batch.write.mode("overwrite").parquet(f"{updates}/batch={epoch}")

        (counted.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).foreachBatch(land).start().awaitTermination())
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    landed = spark.read.schema(f"{_STATE}, batch int").parquet(updates)
    return landed.groupBy("digest").agg(F.min("keeper").alias("keeper"), F.max("group_size").alias("group_size"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """One row per input row: ``doc``, ``locator``, ``digest``, ``keep_id``, ``group_size``, ``kept``.

    With ``folder`` the log, the stream's checkpoint and its state stay there: called again with a table that has grown by
    files, only the new rows (by locator) are logged and streamed, and hit the state of the calls before.

    Null texts count as empty, and empty texts form a group like any other.  Null ids never win
    over an id.  Of rows with equal text and id, the first by locator stays.  An empty table gives
    no rows.  Columns of ``docs`` other than id and text aren't read.
    """
    spark = docs.sparkSession
    folder = folder or scratch(spark, "exact-dedup")
    log_path = f"{folder}/log"
    if exists(spark, log_path):
        at = free_name(docs, "_locator")
        old = spark.read.schema(LOG).parquet(log_path).select(F.col("locator").alias(at))
        arrivals(with_locator(docs, at).join(old, at, "left_anti"), at, id_col, text_col).write.mode("append").parquet(log_path)
    else:
        arrival_log(docs, log_path, id_col, text_col)
    log = spark.read.schema(LOG).parquet(log_path)
    if not log.take(1):
        return log.select("doc", "locator", "digest", F.col("doc").alias("keep_id"),
                          F.lit(0).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    state = written(drain(spark, log_path, f"{folder}/checkpoint", f"{folder}/updates"), "exact-dedup-groups")
    out = log.join(state, "digest").select(
        "doc", "locator", "digest", F.col("keeper.doc").alias("keep_id"), "group_size",
        (F.col("locator") == F.col("keeper.locator")).alias("kept"))
    collided = colliding(docs, log, state, text_col)
    return out if collided is None else _regrouped(docs, out, collided, id_col, text_col)


def colliding(docs: DataFrame, log: DataFrame, state: DataFrame, text_col: str = "text") -> DataFrame | None:
    """Digests of which the full normalised texts differ, or None if there are none."""
    at = free_name(docs, "_locator")
    hits = state.where("group_size > 1").select("digest")
    norm = normalised(F.col(text_col)).alias("_norm")
    if from_files(docs):
        found = written(log.join(hits, "digest").select(F.col("locator").alias(at), "digest"), "exact-dedup-hits")
        texts = with_locator(docs, at).select(at, norm).join(broadcast_if_small(found), at)
    else:                           # running numbers may differ between two evaluations
        texts = docs.select(_digest(text_col).alias("digest"), norm).join(hits, "digest", "left_semi")
    spans = texts.groupBy("digest").agg(F.min("_norm").alias("lo"), F.max("_norm").alias("hi"))
    bad = written(spans.where("lo <> hi").select("digest"), "exact-dedup-collisions")
    return bad if bad.take(1) else None


def _regrouped(docs: DataFrame, out: DataFrame, collided: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Group the rows of colliding digests by their text instead of the digest."""
    at = free_name(docs, "_locator")
    rows = (with_locator(docs, at).select(F.col(id_col).cast("long").alias("doc"), F.col(at).alias("locator"),
                                          _digest(text_col).alias("digest"), normalised(F.col(text_col)).alias("_norm"))
            .join(collided, "digest", "left_semi"))
    groups = rows.groupBy("digest", "_norm").agg(F.min(_keeper()).alias("keeper"),
                                                 F.count(F.lit(1)).alias("group_size"))
    apart = rows.join(groups, ["digest", "_norm"]).select(
        "doc", "locator", "digest", F.col("keeper.doc").alias("keep_id"), "group_size",
        (F.col("locator") == F.col("keeper.locator")).alias("kept"))
    return out.join(collided, "digest", "left_anti").unionByName(apart)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; ``docs`` must be read from files.

    The rows that go are far fewer than those that stay, so they are the side that is joined."""
    at = free_name(docs, "_locator")
    dropped = written(exact_groups(docs, id_col, text_col).where("not kept").select(F.col("locator").alias(at)), "exact-dedup-dropped")
    return with_locator(docs, at).join(dropped, at, "left_anti").select(*docs.columns)
