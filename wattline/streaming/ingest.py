"""Structured Streaming jobs.

Every job reads Kafka-shaped rows (``sources.messages``: the Kafka source on a cluster, Parquet
files here), keeps its offsets and state in a checkpoint under ``spark.checkpoint.dir``, and writes
through an exactly-once sink: the file sink, or ``foreachBatch`` writing each epoch to its own
``batch=<epoch>`` directory with overwrite.  ``trigger(availableNow=True)`` drains what is there and
stops (the bounded drain); a restart on the same checkpoint resumes after the last committed batch,
so nothing is lost or written twice after a failure.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.operators import decode as DC
from wattline.sources import bronze as B
from wattline.sources import messages as M
from wattline.sources import tables as T

WATERMARK = "10 minutes"


#: Size of an arrival file (the largest range of a landing decides how many files each one gets).
ARRIVAL_FILE_BYTES = 32 << 20
#: Row groups of arrival files, before compression: a file is read by several tasks, each with some of its row groups.
ROW_GROUP_BYTES = 8 << 20
_PLAN = "files_per_arrival int"


def landing(spark: SparkSession, sf_dir: str, root: str, chunks: int = 6, held_back: Column | None = None,
            value: Column | None = None) -> str:
    """Arrival files for a stream, under ``root``: the messages of the topic store cut into
    ``chunks`` equal event-time ranges that arrive in time order (the file source replays files in
    arrival order), one micro-batch per range.  Rows matching ``held_back`` are kept out of their
    range and arrive last, as late deliveries.  ``value`` replaces the payload.

    The messages are staged partitioned by range, and each range is read back alone (partition
    pruning) and written as ``n`` round-robin files.  ``n`` follows the bytes of the largest range, so
    no task carries a hot range, and files have short row groups, so that a micro-batch is decoded by all
    cores even if it is one file.  ``n`` is stored beside the files (``files_per_arrival``): every process
    that streams from ``root`` reads ``n`` files per trigger, one range per micro-batch.  A range with fewer
    rows than files gets empty ones."""
    msgs = M.read_topics(spark, M.publish_topics(spark, sf_dir))
    msgs = msgs if value is None else msgs.withColumn("value", value)
    t = F.unix_micros(F.col("timestamp"))
    lo, hi = msgs.agg(F.min(t), F.max(t)).first()
    step = (hi - lo) // chunks + 1
    late = F.lit(False) if held_back is None else F.coalesce(held_back, F.lit(False))
    slot = F.when(late, F.lit(chunks)).otherwise(F.expr(f"(unix_micros(timestamp) - {lo}) div {step}"))
    stage = f"{root}/stage"
    msgs.withColumn("_slot", slot).write.mode("overwrite").partitionBy("_slot").parquet(stage)
    staged = spark.read.parquet(stage)
    slots = range(chunks + (held_back is not None))
    largest = max(sum(f[1] for f in T.files_of(spark, f"{stage}/_slot={i}")) if B.exists(spark, f"{stage}/_slot={i}") else 0
                  for i in slots)
    n = max(1, -(-largest // ARRIVAL_FILE_BYTES))
    for i in slots:
        _write_arrival(staged.filter(F.col("_slot") == i).drop("_slot"), root, n, "append" if i else "overwrite")
    spark.createDataFrame([(n,)], _PLAN).coalesce(1).write.mode("overwrite").parquet(f"{root}/plan")
    return root


def _write_arrival(df: DataFrame, root: str, n: int, mode: str = "append") -> None:
    """One arrival of exactly ``n`` files."""
    spark, data = df.sparkSession, f"{root}/data"

    def write(rows: DataFrame, mode: str) -> None:
        rows.write.mode(mode).option("parquet.block.size", ROW_GROUP_BYTES).parquet(data)

    def files() -> int:
        return sum(f[0].endswith(".parquet") for f in T.files_of(spark, data))
    before = files() if mode == "append" and B.exists(spark, data) else 0
    write(df.repartition(n), mode)
    for _ in range(before + n - files()):
        write(spark.createDataFrame([], df.schema).coalesce(1), "append")


def files_per_arrival(spark: SparkSession, root: str) -> int:
    return spark.read.schema(_PLAN).parquet(f"{root}/plan").first()[0]


def append_arrivals(df: DataFrame, root: str) -> None:
    """Write one arrival (a later micro-batch of the stream from ``root``)."""
    _write_arrival(df, root, files_per_arrival(df.sparkSession, root))


def message_stream(spark: SparkSession, root: str, files_per_trigger: int | None = None) -> DataFrame:
    """The file source with the Kafka columns; ``maxFilesPerTrigger`` bounds a micro-batch
    (by default to the files of one arrival)."""
    return M.file_source(spark, f"{root}/data", files_per_trigger or files_per_arrival(spark, root))


def scada_rows(stream: DataFrame, batch_id: str = "stream") -> DataFrame:
    """Decoded, typed, enriched SCADA rows of a message stream (the Bronze row shape)."""
    d = DC.decode_json(stream.filter(F.col("topic") == "energy.bronze.scada"))
    good, _ = DC.to_table(d, "scada_telemetry", batch_id)
    return good


def ingest_batch(root: str, evolve: bool = False) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body over decoded rows (see ``bronze.land``)."""
    def run(batch: DataFrame, epoch: int) -> None:
        B.land(batch, root, epoch, evolve=evolve)
    return run


def run_available(writer, checkpoint: str):
    """Start with availableNow (bounded drain) and wait for the end; returns the finished query."""
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


LOAD_METRICS = "load_totals"


def ingest(spark: SparkSession, source_path: str, root: str, checkpoint: str,
           files_per_trigger: int | None = None, evolve: bool = False):
    """T1-T4 + A2: Kafka-shaped stream -> Bronze tables + dead letters.  Per-batch counters
    (messages, message-level rejects) are attached with ``observe`` and reported in each
    progress event under ``observedMetrics['load_totals']``.  With ``evolve`` (S17) new payload fields become
    columns in the middle of the stream: payloads are decoded as maps, so the query, its checkpoint and its
    offsets stay as they are."""
    d = DC.decode_json(message_stream(spark, source_path, files_per_trigger))
    d = d.observe(LOAD_METRICS, F.count(F.lit(1)).alias("messages"),
                  F.count_if(F.col("error_message").isNotNull()).alias("rejected_messages"))
    return run_available(d.writeStream.foreachBatch(ingest_batch(root, evolve)), checkpoint)


def feed_rows(stream: DataFrame, feeds: dict[str, str]) -> DataFrame:
    """Good rows of several feeds (topic -> name) as (feed, node_id, timestamp), parsed once."""
    names = F.create_map(*[F.lit(x) for kv in feeds.items() for x in kv])
    good = DC.judged(DC.decode_json(stream.filter(F.col("topic").isin(list(feeds))))).filter(F.col("reject").isNull())
    return good.select(F.element_at(names, F.col("topic")).alias("feed"), F.col("p.node_id").alias("node_id"),
                       F.try_to_timestamp(F.col("p.timestamp")).alias("timestamp"))


def hourly_rollup(rows: DataFrame, value: str = "solar_mw", key: str = "node_id", size: str = "1 hour",
                  slide: str | None = None) -> DataFrame:
    """Tumbling (or sliding) event-time windows per key, with a 10-minute watermark; in
    append mode a window is written once, when the watermark passes its end, and its state is
    dropped.  Sums go through DECIMAL so totals do not depend on batch boundaries."""
    w = F.window("timestamp", size, slide) if slide else F.window("timestamp", size)
    return (rows.withWatermark("timestamp", WATERMARK).groupBy(w.alias("window"), key)
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(value).cast("decimal(28,4)")).alias("mw_sum")))


def rollup_with_late(rows: DataFrame, root: str, checkpoint: str, keep: Sequence[str], value: str = "solar_mw",
                     key: str = "_dataset", size_us: int = 3_600_000_000, delay_us: int = 600_000_000):
    """T6 in one run: windows and, as a branch of its own, the rows that come too late for theirs.

    Each micro-batch is staged once, split by whether the watermark of the batches before (their newest
    event time less the delay) has closed a row's window: ``rows/batch=<epoch>/late=true`` are the late rows
    themselves (columns ``keep``), the others are summed into ``partial/batch=<epoch>``.  ``seen/batch=<epoch>``
    holds the newest event time.  All folders carry the epoch, so a retried batch replaces its own."""
    spark = rows.sparkSession

    def run(batch: DataFrame, epoch: int) -> None:
        seen = f"{root}/seen"
        before = spark.read.parquet(seen).filter(F.col("batch") < epoch).agg(F.max("newest_us")).first()[0] if B.exists(spark, seen) else None
        end = (F.floor(F.unix_micros("timestamp") / size_us) + 1).cast("long") * size_us
        late = F.lit(False) if before is None else end <= F.lit(before - delay_us)
        stage = f"{root}/rows/batch={epoch}"
        staged = batch.select(*dict.fromkeys([*keep, "timestamp", key, value]), end.alias("end_us"), late.alias("late"))
        staged.write.mode("overwrite").partitionBy("late").parquet(stage)
        staged = spark.read.schema(staged.schema).parquet(stage)
        (staged.filter("NOT late").groupBy("end_us", key).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(value).cast("decimal(28,4)")).alias("total"))
         .write.mode("overwrite").parquet(f"{root}/partial/batch={epoch}"))
        (staged.agg(F.max(F.unix_micros("timestamp")).alias("newest_us")).filter("newest_us IS NOT NULL").coalesce(1)
         .write.mode("overwrite").parquet(f"{seen}/batch={epoch}"))
    return run_available(rows.writeStream.foreachBatch(run), checkpoint)


def late_rows(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/rows").filter(F.col("late").cast("boolean")).drop("late", "batch")


def closed_windows(spark: SparkSession, root: str, key: str = "_dataset", delay_us: int = 600_000_000) -> DataFrame:
    """(end_us, key, n, total) of the windows that the last watermark has closed."""
    newest = spark.read.schema("newest_us long, batch int").parquet(f"{root}/seen").agg(F.max("newest_us")).first()[0]
    part = spark.read.parquet(f"{root}/partial").filter(F.col("end_us") <= F.lit((newest or 0) - delay_us))
    return part.groupBy("end_us", key).agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def last_seen(rows: DataFrame, *keys: str) -> DataFrame:
    """Newest event time per key (complete mode: one state row per key)."""
    return rows.groupBy(*keys).agg(F.max("timestamp").alias("last_seen"))


def lag_stats(stream: DataFrame, accuracy: int = 100_000) -> DataFrame:
    """Publish lag (broker time - payload event time) per topic: count, p50, p95, max."""
    d = DC.decode_json(stream).filter(F.col("error_message").isNull())
    lag = (F.unix_micros(F.col("timestamp")) - F.unix_micros(F.try_to_timestamp(F.col("p.timestamp")))) / F.lit(1e6)
    x = d.select("topic", lag.alias("lag_s")).filter(F.col("lag_s").isNotNull())
    return x.groupBy("topic").agg(F.count(F.lit(1)).alias("n"),
                                  F.percentile_approx("lag_s", [0.5, 0.95], accuracy).alias("q"),
                                  F.max("lag_s").alias("max_lag_s"))


def enrich(rows: DataFrame, dim: DataFrame, key: str = "node_id") -> DataFrame:
    """Stream-static join with a node dimension.  The dimension is broadcast only behind a
    bound of rows and bytes; streaming plans have no AQE to decide it at run time."""
    from wattline.operators.joins import broadcast_if_small
    return rows.join(broadcast_if_small(dim, 1_000_000), key, "left")
