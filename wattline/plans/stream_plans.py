"""Streaming queries (T1-T11, O3): each runs its Structured Streaming job with ``availableNow`` over
time-ordered arrival files derived from ``events`` and returns what its sink holds.  Landing, sinks
and checkpoints stand in the shared folder under a name that follows the state of the input: the
same input is not streamed twice, a run that was cut off goes on from its checkpoint, and changed
input starts anew.  The oracle is the batch meaning of the stream (e.g. windows closed by the final
watermark)."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import functions as F

from wattline import schemas
from wattline.functions.columns import dround
from wattline.plans import bronze_plans as BP
from wattline.plans.derive_plans import _climate_col
from wattline.plans.registry import register
from wattline.sources import bronze as B
from wattline.sources import messages as M
from wattline.sources import tables as T
from wattline.streaming import alerts as A
from wattline.streaming import ingest as S

FK = M.FAULTS
CHUNKS = 6
LATE_TENS = 3        # fixed rule of the binding: messages with props.k from 30 to 39 are delivered late
REPLAY_MAX_K = 10    # messages with props.k < 10 are delivered a second time
STALE_AS_OF = "2024-01-31 00:00:00"
#: Minutes after which a feed is stale.
STALE_MINUTES = {"scada": 15, "weather": 120}


#: Bytes of events for each partition of a stream's state, which keeps its number for good.
STATE_BYTES = 16 << 20


@contextmanager
def _sized(spark, sf):
    """Shuffle partitions as the input needs them, one for each core at least and never more than the session's."""
    size = sum(f[1] for f in T.files_of(spark, f"{sf.rstrip('/')}/events.parquet"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(min(int(before), max(spark.sparkContext.defaultParallelism, -(-size // STATE_BYTES)))))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def _derived(spark, sf, name, build):
    """Folder of a finished stream run; ``build(folder)`` runs it."""
    def run(path):
        with _sized(spark, sf):
            build(path)
        spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{path}/end")
    return T.derived(spark, f"{sf.rstrip('/')}/events.parquet", f"stream-{name}", run, end="end/_SUCCESS")


def _landing(spark, sf):
    return T.derived(spark, f"{sf.rstrip('/')}/events.parquet", "landing",
                     lambda path: S.landing(spark, sf, path, CHUNKS), end="plan/_SUCCESS")


def _ingest_root(spark, sf):
    return _derived(spark, sf, "ingest", lambda path: S.ingest(spark, _landing(spark, sf), f"{path}/tables", f"{path}/checkpoint")) + "/tables"


def _file_sink(df, path, mode="append"):
    S.run_available(df.writeStream.format("parquet").option("path", f"{path}/out").outputMode(mode), f"{path}/checkpoint")


def _epoch_sink(df, path, mode, keep_epochs=False):
    """``foreachBatch`` sink: the whole (small, per-key) table anew, or a folder for each epoch."""
    def write(batch, epoch):
        batch.write.mode("overwrite").parquet(f"{path}/out/batch={epoch}" if keep_epochs else f"{path}/out")
    S.run_available(df.writeStream.outputMode(mode).foreachBatch(write), f"{path}/checkpoint")


_SCADA_GOOD = f"""FROM mm WHERE topic = 'energy.bronze.scada' AND error_message IS NULL AND k NOT IN {BP.ROW_REJECT}"""


@register("stream_bronze_ingest", BP.MSG_SQL + BP.ALL_TABLES_SQL, "T1 T2 T3 O3 S5 S7")
def stream_bronze_ingest(spark, sf):
    return B.all_tables(spark, _ingest_root(spark, sf))


@register("stream_dlq", BP._DLQ_SQL + "SELECT topic, partition_id, offset_id, key, error_message, has_value FROM d",
          "T4 S10")
def stream_dlq(spark, sf):
    d = B.read_table(spark, _ingest_root(spark, sf), "dead_letter_queue")
    return d.select("topic", "partition_id", "offset_id", "key", "error_message",
                    F.col("value").isNotNull().alias("has_value"))


@register("stream_replay_dedup", BP.MSG_SQL + f"""
SELECT topic, "partition", "offset", error_message IS NULL AND k NOT IN {BP.ROW_REJECT} AS landed FROM mm""", "T5")
def stream_replay_dedup(spark, sf):
    """Ingest with re-deliveries: a second copy of some messages arrives after everything else,
    however old; the ledger of the load keeps each message from landing (or being rejected) twice."""
    def build(path):
        root = S.landing(spark, sf, f"{path}/landing", CHUNKS)
        k = M.payload_k(F.col("value"))
        again = M.read_topics(spark, M.publish_topics(spark, sf)).filter(F.coalesce(k, F.lit(99)) < REPLAY_MAX_K)
        S.append_arrivals(again, root)
        S.ingest(spark, root, f"{path}/tables", f"{path}/checkpoint")
    root = _derived(spark, sf, "replay", build) + "/tables"
    taken = B.taken_messages(spark, root)
    rows = taken.filter("landed AND topic = 'energy.bronze.plants'").drop("landed")        # plants carry no offset
    for topic, table in schemas.TOPIC_TABLE.items():
        if table != "plants":
            rows = rows.unionByName(B.read_table(spark, root, table).select(
                F.lit(topic).alias("topic"), F.col("_kafka_partition").alias("partition"), F.col("_kafka_offset").alias("offset")))
    dead = B.read_table(spark, root, "dead_letter_queue").select("topic", F.col("partition_id").alias("partition"), F.col("offset_id").alias("offset"))
    return rows.withColumn("landed", F.lit(True)).unionByName(dead.withColumn("landed", F.lit(False)))


def _rollup_path(spark, sf, size="1 hour"):
    def build(path):
        rows = S.scada_rows(S.message_stream(spark, _landing(spark, sf)))
        _file_sink(S.hourly_rollup(rows, size=size), path)
    return _derived(spark, sf, f"rollup-{size.replace(' ', '')}", build) + "/out"


_WM = f"(SELECT MAX(ts) {_SCADA_GOOD}) - INTERVAL 10 MINUTE"
_HOURLY_SQL = BP.MSG_SQL + f""", g AS (SELECT date_trunc('hour', ts) AS window_start, 'N' || user_id AS node_id, mw
  {_SCADA_GOOD}),
w AS (SELECT window_start, node_id, COUNT(*) AS n, CAST(SUM(CAST(mw AS DECIMAL(28,4))) AS DOUBLE) AS mw_sum
      FROM g GROUP BY 1, 2 HAVING window_start + INTERVAL 1 HOUR <= ({_WM}))
"""


@register("stream_hourly_rollup", _HOURLY_SQL + "SELECT * FROM w", "T6")
def stream_hourly_rollup(spark, sf):
    r = spark.read.parquet(_rollup_path(spark, sf))
    return r.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), "node_id", "n",
                    F.col("mw_sum").cast("double").alias("mw_sum"))


@register("stream_missed_windows", BP.MSG_SQL + f""", g AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS ws, 'N' || user_id AS node_id {_SCADA_GOOD}),
w AS (SELECT DISTINCT ws, node_id FROM g WHERE ws + INTERVAL 5 MINUTE <= ({_WM})),
b AS (SELECT CAST(epoch(MAX(ws) - MIN(ws)) / 300 AS BIGINT) + 1 AS windows_expected FROM w)
SELECT n.node_id, windows_expected, COUNT(ws) AS windows_seen, windows_expected - COUNT(ws) AS windows_missed,
       MAX(ws) AS last_window
FROM (SELECT DISTINCT node_id FROM g) n CROSS JOIN b LEFT JOIN w ON w.node_id = n.node_id GROUP BY 1, 2""", "T9 J9")
def stream_missed_windows(spark, sf):
    """5-minute windows that each node missed over the span of all nodes, so a node that went silent
    (at either end, or before its first closed window) misses what the others have sent."""
    w = spark.read.parquet(_rollup_path(spark, sf, "5 minutes")).select(F.col("window.start").alias("ws"), "node_id")
    span = w.agg(((F.unix_micros(F.max("ws")) - F.unix_micros(F.min("ws"))) / F.lit(300_000_000)).cast("long").alias("span"))
    known = B.read_table(spark, _ingest_root(spark, sf), "scada_telemetry").groupBy("node_id").agg(F.lit(1).alias("_"))
    seen = w.groupBy("node_id").agg(F.count(F.lit(1)).alias("windows_seen"), F.max("ws").alias("last_window"))
    out = known.join(seen, "node_id", "left").crossJoin(F.broadcast(span))       # one row
    n = F.coalesce("windows_seen", F.lit(0))
    return out.select("node_id", (F.col("span") + 1).alias("windows_expected"), n.alias("windows_seen"),
                      (F.col("span") + 1 - n).alias("windows_missed"), F.col("last_window").cast("timestamp_ntz").alias("last_window"))


# Spark filters late rows against the watermark of the batch before the one they arrive in, and
# evicts state with the current one.  Late rows arrive in the batch after the last chunk, so their
# filter watermark comes from the chunks up to the second-to-last; chunks are cut on broker time.
_LATE_SQL = BP.MSG_SQL + f""", b AS (SELECT MIN(epoch_us(ts + to_seconds(k))) AS lo,
                                       MAX(epoch_us(ts + to_seconds(k))) AS hi FROM mm),
g AS (SELECT ts, k // 10 = {LATE_TENS} AS late, CASE WHEN k <> {FK['no_dataset']} THEN ds ELSE 'unknown' END AS dataset,
             date_trunc('hour', ts) + INTERVAL 1 HOUR AS wend,
             (epoch_us(ts + to_seconds(k)) - lo) // ((hi - lo) // {CHUNKS} + 1) AS chunk
      FROM mm, b WHERE topic = 'energy.bronze.scada' AND error_message IS NULL AND k NOT IN {BP.ROW_REJECT}),
wl AS (SELECT MAX(ts) - INTERVAL 10 MINUTE AS wm FROM g WHERE NOT late AND chunk <= {CHUNKS - 2}),
wf AS (SELECT MAX(ts) - INTERVAL 10 MINUTE AS wm FROM g),
kept AS (SELECT g.* FROM g, wl WHERE NOT late OR g.wend > wl.wm)
SELECT (SELECT COUNT(*) FROM g, wl WHERE late AND wend <= wl.wm) AS late_rows_dropped,
       (SELECT COUNT(*) FROM (SELECT DISTINCT wend, dataset FROM kept, wf WHERE wend <= wf.wm)) AS windows_emitted"""


@register("stream_late_rows", _LATE_SQL, "T6")
def stream_late_rows(spark, sf):
    """Late deliveries: rows held back and delivered after the rest; many of them share a window.

    A row is dropped when its window's end is at or below the watermark.  The count is of input rows:
    the good rows of the landing less the rows that all windows, open ones included, have counted
    (an update-mode run).  The windows emitted are those of the append-mode run."""
    k = M.payload_k(F.col("value"))
    held = F.coalesce(F.floor(k / 10) == LATE_TENS, F.lit(False))
    root = T.derived(spark, f"{sf.rstrip('/')}/events.parquet", "landing-late",
                     lambda path: S.landing(spark, sf, path, CHUNKS, held), end="plan/_SUCCESS")

    def windows():
        return S.hourly_rollup(S.scada_rows(S.message_stream(spark, root)), key="_dataset")
    emitted = spark.read.parquet(_derived(spark, sf, "late", lambda path: _file_sink(windows(), path)) + "/out")
    updates = spark.read.parquet(_derived(spark, sf, "late-updates", lambda path: _epoch_sink(windows(), path, "update", True)) + "/out")
    counted = updates.groupBy("window", "_dataset").agg(F.max("n").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("counted"))
    sent = S.scada_rows(spark.read.parquet(f"{root}/data")).agg(F.count(F.lit(1)).alias("sent"))
    return (emitted.agg(F.count(F.lit(1)).alias("windows_emitted")).crossJoin(counted).crossJoin(sent)    # one row each
            .select((F.col("sent") - F.col("counted")).alias("late_rows_dropped"), "windows_emitted"))


_LATE_ROWS_SQL = BP.MSG_SQL + f""",
g AS (SELECT topic, "partition", "offset", ts, mw, k // 10 = {LATE_TENS} AS late,
             CASE WHEN k <> {FK['no_dataset']} THEN ds ELSE 'unknown' END AS dataset, date_trunc('hour', ts) + INTERVAL 1 HOUR AS wend
      FROM mm WHERE topic = 'energy.bronze.scada' AND error_message IS NULL AND k NOT IN {BP.ROW_REJECT}),
wm AS (SELECT MAX(ts) FILTER (NOT late) - INTERVAL 10 MINUTE AS before, MAX(ts) - INTERVAL 10 MINUTE AS last FROM g)
"""


@register("stream_late_branch", _LATE_ROWS_SQL + """
SELECT 'late' AS kind, "partition", "offset", ts AS event_time, wend AS window_end, dataset, mw AS total, 1::BIGINT AS n
FROM g, wm WHERE late AND wend <= before
UNION ALL
SELECT 'window', NULL, NULL, NULL, wend, dataset, CAST(SUM(CAST(mw AS DECIMAL(28,4))) AS DOUBLE), COUNT(*)
FROM g, wm WHERE NOT (late AND wend <= before) AND wend <= last GROUP BY wend, dataset""", "T6")
def stream_late_branch(spark, sf):
    """One run: hourly windows, and the late rows themselves as a table of their own."""
    k = M.payload_k(F.col("value"))
    held = F.coalesce(F.floor(k / 10) == LATE_TENS, F.lit(False))
    root = T.derived(spark, f"{sf.rstrip('/')}/events.parquet", "landing-late",
                     lambda path: S.landing(spark, sf, path, CHUNKS, held), end="plan/_SUCCESS")
    out = _derived(spark, sf, "late-branch", lambda path: S.rollup_with_late(
        S.scada_rows(S.message_stream(spark, root)), path, f"{path}/checkpoint", ["_kafka_partition", "_kafka_offset"]))
    end = F.timestamp_micros("end_us").cast("timestamp_ntz").alias("window_end")
    late = S.late_rows(spark, out).select(
        F.lit("late").alias("kind"), F.col("_kafka_partition").alias("partition"), F.col("_kafka_offset").alias("offset"),
        F.col("timestamp").cast("timestamp_ntz").alias("event_time"), end, F.col("_dataset").alias("dataset"),
        F.col("solar_mw").alias("total"), F.lit(1).cast("long").alias("n"))
    windows = S.closed_windows(spark, out).select(
        F.lit("window").alias("kind"), F.lit(None).cast("int").alias("partition"), F.lit(None).cast("long").alias("offset"),
        F.lit(None).cast("timestamp_ntz").alias("event_time"), end, F.col("_dataset").alias("dataset"),
        F.col("total").cast("double").alias("total"), "n")
    return late.unionByName(windows)


@register("stream_evolution", BP.MSG_SQL + f"""
SELECT "partition", "offset" AS _kafka_offset, CASE WHEN ts >= TIMESTAMP '{BP.EVOLVE_AT}' THEN CAST(k AS DOUBLE) / 2 END AS inverter_temp_c,
       CASE WHEN ts >= TIMESTAMP '{BP.EVOLVE_AT}' THEN 'F' || k // 10 END AS firmware {_SCADA_GOOD}""", "S17 T1")
def stream_evolution(spark, sf):
    """Two fields appear in the payloads in the middle of the stream (a number and a text); the table gets both
    columns from that micro-batch on, earlier rows are NULL there."""
    def build(path):
        text = F.col("value").cast("string")
        k = M.payload_k(F.col("value"))
        more = F.concat(F.lit(',"inverter_temp_c":"'), (k / 2).cast("string"), F.lit('","firmware":"F'), F.floor(k / 10).cast("string"), F.lit('"}'))
        since = F.get_json_object(text, "$.timestamp") >= F.lit(BP.EVOLVE_AT.replace(" ", "T"))
        new = (F.col("topic") == "energy.bronze.scada") & F.is_valid_utf8(text) & text.endswith("}") & k.isNotNull() & since
        value = F.when(new, F.encode(F.concat(F.expr("substring(cast(value as string), 1, length(cast(value as string)) - 1)"), more), "UTF-8")
                       ).otherwise(F.col("value"))
        root = S.landing(spark, sf, f"{path}/landing", CHUNKS, value=value)
        S.ingest(spark, root, f"{path}/tables", f"{path}/checkpoint", evolve=True)
    t = B.read_table(spark, _derived(spark, sf, "evolution", build) + "/tables", "scada_telemetry", merge_schema=True)
    return t.select(F.col("_kafka_partition").alias("partition"), "_kafka_offset", "inverter_temp_c", "firmware")


_STALE_SQL = " ".join(f"WHEN '{f}' THEN {m}" for f, m in STALE_MINUTES.items())


@register("stream_staleness", BP.MSG_SQL + f""", g AS (SELECT split_part(topic, '.', 3) AS feed, 'N' || user_id AS node_id, MAX(ts) AS last_seen
  FROM mm WHERE topic IN ({', '.join(f"'energy.bronze.{f}'" for f in STALE_MINUTES)}) AND error_message IS NULL AND k NOT IN {BP.ROW_REJECT}
  GROUP BY 1, 2)
SELECT feed, node_id, last_seen,
       CAST(round(CAST((epoch_us(TIMESTAMP '{STALE_AS_OF}') - epoch_us(last_seen)) / 6e7 AS DECIMAL(38,9)), 2) AS DOUBLE)
         AS minutes_since,
       (epoch_us(TIMESTAMP '{STALE_AS_OF}') - epoch_us(last_seen)) / 6e7 > CASE feed {_STALE_SQL} END AS is_stale FROM g""", "T7")
def stream_staleness(spark, sf):
    def build(path):
        rows = S.feed_rows(S.message_stream(spark, _landing(spark, sf)), {f"energy.bronze.{f}": f for f in STALE_MINUTES})
        _epoch_sink(S.last_seen(rows, "feed", "node_id"), path, "complete")
    r = spark.read.parquet(_derived(spark, sf, "stale", build) + "/out")
    mins = (F.unix_micros(F.lit(STALE_AS_OF).cast("timestamp")) - F.unix_micros("last_seen")) / F.lit(6e7)
    limit = F.element_at(F.create_map(*[F.lit(x) for kv in STALE_MINUTES.items() for x in kv]), F.col("feed"))
    return r.select("feed", "node_id", F.col("last_seen").cast("timestamp_ntz").alias("last_seen"),
                    dround(mins, 2).alias("minutes_since"), (mins > limit).alias("is_stale"))


_LIMIT_US = "CASE feed " + " ".join(f"WHEN '{f}' THEN {m * 60_000_000}" for f, m in STALE_MINUTES.items()) + " END"


# The alerts are the gaps between consecutive readings of closed windows, and what is open at the last watermark.
@register("stream_alerts", BP.MSG_SQL + f""", g AS (
  SELECT split_part(topic, '.', 3) AS feed, 'N' || user_id AS node_id, epoch_us(ts) AS t, epoch_us(ts) // {A.WINDOW_US} * {A.WINDOW_US} + {A.WINDOW_US} AS we
  FROM mm WHERE topic IN ({', '.join(f"'energy.bronze.{f}'" for f in STALE_MINUTES)}) AND error_message IS NULL AND k NOT IN {BP.ROW_REJECT}),
wm AS (SELECT MAX(t) - 600000000 AS wm FROM g),
c AS (SELECT g.*, {_LIMIT_US} AS lim, LEAD(t) OVER w AS nt, LEAD(we) OVER w AS nwe FROM g, wm WHERE we <= wm
      WINDOW w AS (PARTITION BY feed, node_id ORDER BY t)),
e AS (SELECT feed, node_id, 'stale' AS alert, 'raised' AS event, t + lim AS event_us, t, NULL AS n FROM c, wm
      WHERE nt > t + lim OR (nt IS NULL AND (t + lim + {A.WINDOW_US} - 1) // {A.WINDOW_US} * {A.WINDOW_US} < wm)
      UNION ALL SELECT feed, node_id, 'stale', 'cleared', nt, t, NULL FROM c WHERE nt > t + lim
      UNION ALL SELECT feed, node_id, 'missed', 'raised', we + {A.WINDOW_US}, t, NULL FROM c, wm
      WHERE nwe > we + {A.WINDOW_US} OR (nt IS NULL AND we + {A.WINDOW_US} < wm)
      UNION ALL SELECT feed, node_id, 'missed', 'cleared', nt, t, (nwe - we) // {A.WINDOW_US} - 1 FROM c WHERE nwe > we + {A.WINDOW_US})
SELECT feed, node_id, alert, event, make_timestamp(event_us) AS event_at, make_timestamp(t) AS last_seen, n::BIGINT AS n_missed FROM e""", "T7 T9")
def stream_alerts(spark, sf):
    """Alerts that the stream raises by timers and clears when a node comes back (scada after 15 minutes,
    weather after two hours; 5-minute windows)."""
    def build(path):
        root = _landing(spark, sf)
        before = A.use_disk_state(spark, sum(f[1] for f in T.files_of(spark, f"{root}/data")))
        try:
            rows = S.feed_rows(S.message_stream(spark, root), {f"energy.bronze.{f}": f for f in STALE_MINUTES})
            _file_sink(A.alerts(rows, STALE_MINUTES), path)
        finally:
            A.restore(spark, before)
    r = spark.read.parquet(_derived(spark, sf, "alert-events", build) + "/out")
    return r.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("event_at", "last_seen")})


@register("stream_ingestion_lag", BP.MSG_SQL + """
SELECT topic, COUNT(*) AS n, CAST(quantile_disc(k, 0.5) AS DOUBLE) AS p50_lag_s,
       CAST(quantile_disc(k, 0.95) AS DOUBLE) AS p95_lag_s, CAST(MAX(k) AS DOUBLE) AS max_lag_s,
       quantile_disc(k, 0.95) < 300 AS meets_target
FROM mm WHERE error_message IS NULL AND topic <> 'energy.bronze.plants' GROUP BY 1""", "T8")
def stream_ingestion_lag(spark, sf):
    r = spark.read.parquet(_derived(spark, sf, "lag", lambda path: _epoch_sink(
        S.lag_stats(S.message_stream(spark, _landing(spark, sf))), path, "complete")) + "/out")
    return r.select("topic", "n", F.col("q")[0].alias("p50_lag_s"), F.col("q")[1].alias("p95_lag_s"),
                    "max_lag_s", (F.col("q")[1] < 300).alias("meets_target"))


_CLIM_SQL = "([" + ", ".join(f"'{c}'" for c in M.CLIMATES) + f"])[(user_id % {len(M.CLIMATES)}) + 1]"


@register("stream_enrich", BP.MSG_SQL + f"""
SELECT "offset" AS _kafka_offset, 'N' || user_id AS node_id, {_CLIM_SQL} AS climate {_SCADA_GOOD}""", "T10 J6")
def stream_enrich(spark, sf):
    def build(path):
        dim = (T.telemetry(spark, sf).select("node_id").distinct()
               .select(F.concat(F.lit("N"), F.col("node_id").cast("string")).alias("node_id"),
                       _climate_col(F.col("node_id")).alias("climate")))
        rows = S.scada_rows(S.message_stream(spark, _landing(spark, sf)))
        _file_sink(S.enrich(rows, dim).select("_kafka_offset", "node_id", "climate"), path)
    return spark.read.parquet(_derived(spark, sf, "enrich", build) + "/out")


@register("stream_moving_average", BP.MSG_SQL + f""", g AS (SELECT ts, 'N' || user_id AS node_id, mw {_SCADA_GOOD}),
x AS (SELECT time_bucket(INTERVAL 15 MINUTE, ts) - j * INTERVAL 15 MINUTE AS window_start, node_id, mw
      FROM g, (SELECT unnest([0, 1, 2, 3]) AS j))
SELECT window_start, node_id, COUNT(*) AS n,
       {'CAST(round(CAST(CAST(SUM(CAST(mw AS DECIMAL(28,4))) AS DOUBLE) / COUNT(*) AS DECIMAL(38,9)), 4) AS DOUBLE)'} AS avg_mw
FROM x GROUP BY 1, 2 HAVING window_start + INTERVAL 1 HOUR <= ({_WM})""", "T11")
def stream_moving_average(spark, sf):
    def build(path):
        rows = S.scada_rows(S.message_stream(spark, _landing(spark, sf)))
        _file_sink(S.hourly_rollup(rows, slide="15 minutes"), path)
    r = spark.read.parquet(_derived(spark, sf, "movavg", build) + "/out")
    return r.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), "node_id", "n",
                    dround(F.col("mw_sum").cast("double") / F.col("n"), 4).alias("avg_mw"))
