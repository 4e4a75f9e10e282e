"""Bronze queries (S1-S13, S17, S20, P1-P6, U1, F1, F5, V16) on messages derived from ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattline import schemas
from wattline.operators import decode as DC
from wattline.plans.registry import register
from wattline.plans.views import with_views
from wattline.session import scratch_path
from wattline.sources import bronze as B
from wattline.sources import landing as L
from wattline.sources import messages as M
from wattline.sources import tables as T

BATCH = "batch-0"
FK = M.FAULTS
#: Faults that no repair mends.
NOT_JSON = ("trailing_text", "two_objects", "single_quotes", "forged_end")
ROW_REJECT = (FK["bad_number"], FK["no_node"])
ISO_SQL = "'%Y-%m-%dT%H:%M:%S.%f'"

# DuckDB form of ``messages.telemetry_messages``: what each event's message is and how it breaks.
MSG_SQL = f"""WITH sent AS (
  SELECT event_id, CAST(user_id % {M.PARTITIONS} AS INTEGER) AS "partition",
         CASE event_type {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in M.TOPIC_OF_SOURCE.items())} END AS topic,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, user_id, ts, value AS mw, event_type
  FROM events),
m AS (SELECT *, row_number() OVER (PARTITION BY topic, "partition" ORDER BY ts + to_seconds(k), event_id) - 1 AS "offset" FROM sent),
mm AS (SELECT *,
         CASE WHEN k = {FK['null_payload']} THEN 'null payload' WHEN k = {FK['bad_utf8']} THEN 'invalid utf-8'
              WHEN k = {FK['array']} THEN 'not a json object'
              WHEN k IN ({FK['truncated']}, {', '.join(str(FK[f]) for f in NOT_JSON)}) THEN 'invalid json' END
           AS error_message,
         CASE WHEN k < 50 THEN 'chile' ELSE 'ff' END AS ds
       FROM m)
"""


def _topics(spark, sf, topics=None):
    return M.read_topics(spark, M.publish_topics(spark, sf), topics)


def _msgs(spark, sf, topics=None):
    return DC.decode_json(_topics(spark, sf, topics))


@register("publish_messages", MSG_SQL + f"""
SELECT CASE WHEN k = {FK['no_node']} THEN
              CASE WHEN event_type = 'error' THEN 'PLT-' || event_id ELSE ':' || strftime(ts, {ISO_SQL}) END
            ELSE 'N' || user_id || CASE WHEN event_type <> 'error' THEN ':' || strftime(ts, {ISO_SQL}) ELSE '' END
       END AS key,
       topic, "partition", "offset", ts + to_seconds(k) AS timestamp, k = {FK['null_payload']} AS value_is_null
FROM mm""", "S3 S4")
def publish_messages(spark, sf):
    m = _topics(spark, sf)
    return m.select(F.col("key").cast("string").alias("key"), "topic", "partition", "offset",
                    F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
                    F.col("value").isNull().alias("value_is_null"))


@register("publish_rows", with_views("demand") + """
SELECT 'N' || node_id || ':' || strftime(ts, '%Y-%m-%d %H:%M:%S') AS key, 'N' || node_id AS node_id, reading_id::VARCHAR AS reading_id,
       demand_mw AS demand_mw, 'ff' AS _dataset, true AS in_partition FROM demand""", "S3 P1")
def publish_rows(spark, sf):
    """Rows published to a topic and read back by a consumer: key, every field as text, the dataset, and a partition
    that follows from the key."""
    d = T.demand(spark, sf).select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
                                   F.concat(F.lit("N"), F.col("node_id").cast("string")).alias("node_id"), "reading_id", "demand_mw")
    m = DC.decode_json(M.publish(d, "energy.bronze.demand", "ff")).filter(F.col("error_message").isNull())
    return m.select(F.col("key").cast("string").alias("key"), F.col("p.node_id").alias("node_id"), F.col("p.reading_id").alias("reading_id"),
                    F.col("p.demand_mw").cast("double").alias("demand_mw"), F.col("p._dataset").alias("_dataset"),
                    (F.col("partition") == F.pmod(F.xxhash64(F.col("key").cast("string")), F.lit(M.PARTITIONS))).alias("in_partition"))


@register("decode_json", MSG_SQL + f"""
SELECT topic, "partition", "offset", error_message,
       CASE WHEN error_message IS NULL AND k <> {FK['no_node']} THEN 'N' || user_id END AS node_id,
       CASE WHEN error_message IS NULL AND k <> {FK['no_dataset']} THEN ds END AS _dataset
FROM mm""", "P1 S5")
def decode_json(spark, sf):
    d = _msgs(spark, sf)
    ok = F.col("error_message").isNull()
    return d.select("topic", "partition", "offset", "error_message",
                    F.when(ok, F.col("p.node_id")).alias("node_id"), F.when(ok, F.col("p._dataset")).alias("_dataset"))


@register("normalize_currency", MSG_SQL + f"""
SELECT "offset", CASE WHEN k <> {FK['no_dataset']} THEN ds END AS _dataset,
       CAST(k AS DOUBLE) AS spot_price, mw AS revenue, CAST(NULL AS DOUBLE) AS ppa_price,
       CAST(NULL AS DOUBLE) AS curtailment_cost
FROM mm WHERE topic = 'energy.bronze.dispatch' AND error_message IS NULL""", "P3 B13")
def normalize_currency(spark, sf):
    d = DC.normalize_currency(_msgs(spark, sf).filter(
        (F.col("topic") == "energy.bronze.dispatch") & F.col("error_message").isNull()))
    return d.select("offset", F.col("p._dataset").alias("_dataset"),
                    *[F.col(m).try_cast("double").alias(m) for m in ("spot_price", "revenue", "ppa_price", "curtailment_cost")])


@register("normalize_ppa", MSG_SQL + f"""
SELECT "offset", CAST(k AS DOUBLE) AS ppa_price_mwh
FROM mm WHERE topic = 'energy.bronze.plants' AND error_message IS NULL""", "P4")
def normalize_ppa(spark, sf):
    d = DC.normalize_ppa(_msgs(spark, sf).filter(
        (F.col("topic") == "energy.bronze.plants") & F.col("error_message").isNull()))
    return d.select("offset", F.col("ppa_price_mwh").try_cast("double").alias("ppa_price_mwh"))


_SCADA_NULLS = ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in ("hydro_mw", "geothermal_mw", "tidal_mw",
                                                                     "total_generation_mw"))


@register("project_to_schema", MSG_SQL + f"""
SELECT "offset", strftime(ts, {ISO_SQL}) AS timestamp,
       CASE WHEN k <> {FK['no_node']} THEN 'N' || user_id END AS node_id,
       CASE WHEN k = {FK['bad_number']} THEN 'n/a' ELSE CAST(mw AS VARCHAR) END AS solar_mw,
       CAST(k AS VARCHAR) AS wind_mw, {_SCADA_NULLS}
FROM mm WHERE topic = 'energy.bronze.scada' AND error_message IS NULL""", "P5")
def project_to_schema(spark, sf):
    d = _msgs(spark, sf).filter((F.col("topic") == "energy.bronze.scada") & F.col("error_message").isNull())
    p = DC.project_to_schema(d, "scada_telemetry")
    cols = [n for n, _, _ in schemas.BRONZE_COLUMNS["scada_telemetry"]]
    return p.select("offset", *cols)


def _scada_typed(spark, sf):
    d = _msgs(spark, sf).filter((F.col("topic") == "energy.bronze.scada") & F.col("error_message").isNull())
    return DC.cast_typed(DC.project_to_schema(d, "scada_telemetry"), "scada_telemetry")


_SCADA_TYPED_SQL = f"""
SELECT "offset", ts AS timestamp, CASE WHEN k <> {FK['no_node']} THEN 'N' || user_id END AS node_id,
       CASE WHEN k <> {FK['bad_number']} THEN mw END AS solar_mw, CAST(k AS DOUBLE) AS wind_mw,
       CAST(NULL AS DOUBLE) AS hydro_mw, CAST(NULL AS DOUBLE) AS geothermal_mw, CAST(NULL AS DOUBLE) AS tidal_mw,
       CAST(NULL AS DOUBLE) AS total_generation_mw,
       list_filter([CASE WHEN k = {FK['no_node']} THEN 'missing node_id' END,
                    CASE WHEN k = {FK['bad_number']} THEN 'bad solar_mw' END], lambda x: x IS NOT NULL) AS reasons,
       k NOT IN {ROW_REJECT} AS is_good
FROM mm WHERE topic = 'energy.bronze.scada' AND error_message IS NULL"""


@register("cast_typed", MSG_SQL + _SCADA_TYPED_SQL, "P6 F5 S13")
def cast_typed(spark, sf):
    t = _scada_typed(spark, sf)
    cols = [n for n, _, _ in schemas.BRONZE_COLUMNS["scada_telemetry"]]
    return t.select("offset", *[F.col(c).cast("timestamp_ntz").alias(c) if c == "timestamp" else F.col(c) for c in cols],
                    "reasons", "is_good")


@register("enrich_meta", MSG_SQL + f"""
SELECT "offset", topic AS _source, '{BATCH}' AS _batch_id, "partition" AS _kafka_partition,
       "offset" AS _kafka_offset, CASE WHEN k <> {FK['no_dataset']} THEN ds ELSE 'unknown' END AS _dataset,
       CAST(ts AS DATE) AS event_date
FROM mm WHERE topic = 'energy.bronze.scada' AND error_message IS NULL AND k NOT IN {ROW_REJECT}""", "P2")
def enrich_meta(spark, sf):
    t = _scada_typed(spark, sf).filter(F.col("is_good"))
    e = DC.enrich_meta(t, BATCH)
    return e.select("offset", "_source", "_batch_id", "_kafka_partition", "_kafka_offset", "_dataset", "event_date")


ROUTED = [t.split(".")[-1] for t in schemas.TOPIC_TABLE]   # every topic


@register("route_topics", MSG_SQL + f"""
SELECT CASE topic {' '.join(f"WHEN '{t}' THEN '{b}'" for t, b in schemas.TOPIC_TABLE.items())} END AS table_name,
       COUNT_IF(error_message IS NULL AND k NOT IN {ROW_REJECT}) AS landed,
       COUNT_IF(error_message IS NOT NULL OR k IN {ROW_REJECT}) AS rejected
FROM mm WHERE topic IN ({', '.join(f"'energy.bronze.{t}'" for t in ROUTED)}) GROUP BY 1""", "S12 S6 F1")
def route_topics(spark, sf):
    """One scan and one parse: each message's outcome is judged once and counted by topic."""
    names = F.create_map(*[F.lit(x) for kv in schemas.TOPIC_TABLE.items() for x in kv])
    return DC.outcomes(_msgs(spark, sf, ROUTED)).select(F.element_at(names, F.col("topic")).alias("table_name"), "landed", "rejected")


def _dlq(spark, sf):
    return DC.dlq_one_pass(_msgs(spark, sf), BATCH)


def _first_metric(topic_col: str) -> str:
    return (f"CASE {topic_col} WHEN 'energy.bronze.scada' THEN 'bad solar_mw' WHEN 'energy.bronze.weather' THEN "
            f"'bad temperature_c' WHEN 'energy.bronze.demand' THEN 'bad demand_mw' WHEN 'energy.bronze.dispatch' "
            f"THEN 'bad total_generation_mw' WHEN 'energy.bronze.plants' THEN 'bad capacity_mw' END")


_DLQ_SQL = MSG_SQL + f""", d AS (
SELECT topic, "partition" AS partition_id, "offset" AS offset_id,
       CASE WHEN k = {FK['no_node']} THEN
              CASE WHEN event_type = 'error' THEN 'PLT-' || event_id ELSE ':' || strftime(ts, {ISO_SQL}) END
            ELSE 'N' || user_id || CASE WHEN event_type <> 'error' THEN ':' || strftime(ts, {ISO_SQL}) ELSE '' END
       END AS key,
       COALESCE(error_message, CASE WHEN k = {FK['no_node']} THEN 'missing node_id' ELSE {_first_metric('topic')} END)
         AS error_message,
       '{BATCH}' AS _batch_id, k <> {FK['null_payload']} AS has_value, k
FROM mm WHERE error_message IS NOT NULL OR k IN {ROW_REJECT})
"""


@register("dlq_rows", _DLQ_SQL + "SELECT topic, partition_id, offset_id, key, error_message, _batch_id, has_value FROM d",
          "S10 T4")
def dlq_rows(spark, sf):
    q = _dlq(spark, sf)
    return q.select("topic", "partition_id", "offset_id", "key", "error_message", "_batch_id",
                    F.col("value").isNotNull().alias("has_value"))


def repair(text):
    """S11 fix-up for replay: close a truncated object, unwrap a one-element array."""
    t = F.trim(text)
    return (F.when(t.startswith("[") & t.endswith("]"), F.expr("substring(trim(value), 2, length(trim(value)) - 2)"))
            .when(t.startswith("{") & ~t.endswith("}"), F.concat(t, F.lit("}")))
            .otherwise(text))


@register("dlq_replay", _DLQ_SQL + f""", e AS (
SELECT topic, partition_id, offset_id, CASE WHEN k = {FK['null_payload']} THEN 'null payload'
         WHEN k IN ({FK['bad_utf8']}, {', '.join(str(FK[f]) for f in NOT_JSON)}) THEN 'invalid json'
         WHEN k IN {ROW_REJECT} THEN error_message END AS replay_error FROM d)
SELECT topic, partition_id, offset_id, replay_error, CASE WHEN replay_error IS NULL THEN 1 ELSE 0 END::BIGINT AS times_landed FROM e""", "S11")
def dlq_replay(spark, sf):
    """Re-drive the dead letters of a Bronze load: repair the text, decode again and land what is
    now good (plants included).  The replay runs twice; messages that have landed since are left
    out by the ledger, so the second run adds nothing."""
    root = scratch_path(spark, "replay")
    B.land(_msgs(spark, sf), root, BATCH)
    dead = B.read_table(spark, root, "dead_letter_queue").filter(F.col("batch") == BATCH)
    fixed = dead.select(F.col("key").cast("binary").alias("key"), F.encode(repair(F.col("value")), "UTF-8").alias("value"),
                        "topic", F.col("partition_id").alias("partition"), F.col("offset_id").alias("offset"))
    for run in ("replay-1", "replay-2"):
        B.land(DC.decode_json(fixed), root, run, redrive=True)
    key = ["topic", "partition_id", "offset_id"]
    tried = B.read_table(spark, root, "dead_letter_queue").filter("batch = 'replay-1'").select(
        *key, F.col("error_message").alias("replay_error"))
    # rows of the four series tables carry their offset; a plant's id tells its message, which the ledger has
    rows = B.ledger(spark, root).filter("kind = 'redriven' AND topic = 'energy.bronze.plants'").select(
        "topic", F.col("partition").alias("partition_id"), F.explode(F.sequence("lo", "hi")).alias("offset_id"))
    for topic, table in schemas.TOPIC_TABLE.items():
        if table != "plants":
            rows = rows.unionByName(B.read_table(spark, root, table).filter("batch <> '" + BATCH + "'").select(
                F.lit(topic).alias("topic"), F.col("_kafka_partition").alias("partition_id"), F.col("_kafka_offset").alias("offset_id")))
    landed = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("times_landed"))
    return (dead.select(*key).join(tried, key, "left").join(landed, key, "left")
            .select(*key, "replay_error", F.coalesce("times_landed", F.lit(0)).alias("times_landed")))


@register("dlq_threshold", MSG_SQL + f"""
SELECT topic, COUNT_IF(error_message IS NULL AND k NOT IN {ROW_REJECT}) AS landed,
       COUNT_IF(error_message IS NOT NULL OR k IN {ROW_REJECT}) AS rejected,
       round(COUNT_IF(error_message IS NOT NULL OR k IN {ROW_REJECT}) / COUNT(*), 6) AS reject_share,
       COUNT_IF(error_message IS NOT NULL OR k IN {ROW_REJECT}) / COUNT(*) > 0.05 AS alert
FROM mm GROUP BY 1""", "V16 A2")
def dlq_threshold(spark, sf):
    share = F.col("rejected") / (F.col("landed") + F.col("rejected"))
    return DC.outcomes(_msgs(spark, sf)).select(
        "topic", "landed", "rejected", F.round(share, 6).alias("reject_share"), (share > F.lit(0.05)).alias("alert"))


ALL_TABLES_SQL = f"""
SELECT CASE topic {' '.join(f"WHEN '{t}' THEN '{b}'" for t, b in schemas.TOPIC_TABLE.items())} END AS table_name,
       CASE WHEN event_type = 'error' THEN 'PLT-' || event_id ELSE 'N' || user_id END AS entity,
       CASE WHEN event_type <> 'error' THEN CAST(ts AS DATE) END AS event_date, mw AS metric,
       CASE WHEN k <> {FK['no_dataset']} THEN ds ELSE 'unknown' END AS _dataset
FROM mm WHERE error_message IS NULL AND k NOT IN {ROW_REJECT}"""


def bronze_root(spark, sf):
    """Root of the Bronze tables that one batch load of the messages has made."""
    return T.derived(spark, f"{sf.rstrip('/')}/events.parquet", "bronze", lambda path: B.land(_msgs(spark, sf), path, BATCH),
                     end=f"{B.LEDGER}/00000000-{BATCH}/_SUCCESS")


@register("bronze_ingest", MSG_SQL + ALL_TABLES_SQL, "S7 S8 S9 S13 S14 T1")
def bronze_ingest(spark, sf):
    root = scratch_path(spark, "bronze")
    B.land(_msgs(spark, sf), root, BATCH)
    return B.all_tables(spark, root)


@register("bronze_gate", MSG_SQL + f""", t AS ({ALL_TABLES_SQL}),
n AS (SELECT table_name, COUNT(*) AS row_count FROM t GROUP BY 1
      UNION ALL SELECT 'dead_letter_queue', COUNT_IF(error_message IS NOT NULL OR k IN {ROW_REJECT}) FROM mm)
SELECT table_name, row_count, table_name = 'dead_letter_queue' OR row_count >= {schemas.MIN_ROWS} AS passes FROM n""", "A1 A2 O2")
def bronze_gate(spark, sf):
    """Row-count gate of a load: the five Bronze tables against the minimum, and the dead letters."""
    root = bronze_root(spark, sf)
    counts = B.all_tables(spark, root).groupBy("table_name").agg(F.count(F.lit(1)).alias("row_count"))
    dead = B.read_table(spark, root, "dead_letter_queue").agg(F.count(F.lit(1)).alias("row_count"))
    both = counts.unionByName(dead.withColumn("table_name", F.lit("dead_letter_queue")))
    names = spark.createDataFrame([(t,) for t in [*schemas.TOPIC_TABLE.values(), "dead_letter_queue"]], "table_name string")
    return (names.join(both, "table_name", "left").withColumn("row_count", F.coalesce("row_count", F.lit(0)))
            .withColumn("passes", (F.col("table_name") == "dead_letter_queue") | (F.col("row_count") >= schemas.MIN_ROWS)))


@register("union_datasets", MSG_SQL + f"""
SELECT "offset", CASE WHEN k <> {FK['no_dataset']} THEN ds END AS _dataset,
       CASE WHEN k <> {FK['no_dataset']} AND ds = 'chile' THEN -CAST(k AS DOUBLE) END AS lat,
       CASE WHEN k <> {FK['no_dataset']} AND ds = 'chile' THEN mw END AS lon,
       CASE WHEN ds = 'chile' AND k NOT IN ({FK['no_dataset']}, {FK['other_currency']}) THEN CAST(k AS DOUBLE) END AS ppa_price_usd_mwh,
       CASE WHEN NOT (ds = 'chile' AND k <> {FK['no_dataset']}) THEN CAST(k AS DOUBLE) END AS ppa_price_gil_mwh
FROM mm WHERE topic = 'energy.bronze.plants' AND error_message IS NULL""", "U1")
def union_datasets(spark, sf):
    d = _msgs(spark, sf).filter((F.col("topic") == "energy.bronze.plants") & F.col("error_message").isNull())
    chile = d.filter(F.col("p._dataset") == "chile").select(
        "offset", F.col("p._dataset").alias("_dataset"), F.col("p.lat").try_cast("double").alias("lat"),
        F.col("p.lon").try_cast("double").alias("lon"), F.col("p.ppa_price_usd_mwh").try_cast("double").alias("ppa_price_usd_mwh"))
    ff = d.filter(~F.coalesce(F.col("p._dataset") == "chile", F.lit(False))).select(
        "offset", F.col("p._dataset").alias("_dataset"),
        F.col("p.ppa_price_gil_mwh").try_cast("double").alias("ppa_price_gil_mwh"))
    return chile.unionByName(ff, allowMissingColumns=True)


EVOLVE_AT = "2024-01-16 00:00:00"


@register("schema_evolution", MSG_SQL + f"""
SELECT "offset" AS _kafka_offset, CASE WHEN ts >= TIMESTAMP '{EVOLVE_AT}' THEN CAST(k AS DOUBLE) / 2 END AS inverter_temp_c
FROM mm WHERE topic = 'energy.bronze.scada' AND error_message IS NULL AND k NOT IN {ROW_REJECT}""", "S17")
def schema_evolution(spark, sf):
    """Two appends to one table, the second with a new column; the table is read back with
    ``mergeSchema`` and the older files show NULL for the new column."""
    root = scratch_path(spark, "evolve")
    good, _ = DC.to_table(_msgs(spark, sf).filter(F.col("topic") == "energy.bronze.scada"), "scada_telemetry", BATCH)
    cut = F.lit(EVOLVE_AT).cast("timestamp")
    B.append_table(good.filter(F.col("timestamp") < cut), root, "scada_telemetry")
    B.append_table(good.filter(F.col("timestamp") >= cut).withColumn("inverter_temp_c", F.col("wind_mw") / 2),
                   root, "scada_telemetry")
    back = B.read_table(spark, root, "scada_telemetry", merge_schema=True)
    return back.select("_kafka_offset", "inverter_temp_c")


# Five landed feeds: weather files of JSON lines, operator files of CSV with a header, trading files of nested JSON
# over several lines, registry extracts of fixed-width records, and meter files of tagged, delimited records.
LANDING_FIELDS = ["timestamp", "node_id", "climate", "temperature_c", "humidity_pct", "_dataset"]
_LANDED_JSON = f"k IN ({FK['truncated']}, {FK['bad_utf8']}, {FK['single_quotes']})"


@register("landing_scan", MSG_SQL + f"""
SELECT 'weather' AS feed, CASE WHEN NOT {_LANDED_JSON} AND k <> {FK['no_node']} THEN 'N' || user_id END AS node_id,
       CASE WHEN NOT {_LANDED_JSON} AND k <> {FK['bad_number']} THEN mw END AS metric, {_LANDED_JSON} AS is_corrupt,
       NOT {_LANDED_JSON} AND k NOT IN {ROW_REJECT} AS is_good, 'weather' AS _source,
       CASE WHEN NOT {_LANDED_JSON} AND k <> {FK['no_dataset']} THEN ds ELSE 'unknown' END AS _dataset
FROM mm WHERE topic = 'energy.bronze.weather' AND k <> {FK['null_payload']}
UNION ALL
SELECT 'operator', CASE WHEN k <> {FK['no_node']} THEN 'N' || user_id END, CASE WHEN k <> {FK['bad_number']} THEN mw END, false,
       k NOT IN {ROW_REJECT}, 'operator', CASE WHEN k <> {FK['no_dataset']} THEN ds ELSE 'unknown' END
FROM mm WHERE topic = 'energy.bronze.demand' AND error_message IS NULL
""" + "".join(f"""
UNION ALL
SELECT '{feed}', CASE WHEN NOT c AND k <> {FK['no_node']} THEN 'N' || user_id END, CASE WHEN NOT c AND k <> {FK['bad_number']} THEN mw END, c,
       NOT c AND k NOT IN {ROW_REJECT}, '{feed}', CASE WHEN NOT c AND k <> {FK['no_dataset']} THEN ds ELSE 'unknown' END
FROM (SELECT *, k % 10 = {digit} AS c FROM mm) WHERE topic = 'energy.bronze.{topic}' AND error_message IS NULL"""
    for feed, (topic, _, digit) in L.FEEDS.items()), "S20 P2 P5 P6")
def landing_scan(spark, sf):
    """Landed files read back with a declared all-string schema in PERMISSIVE mode (broken JSON lines
    keep their text in ``_corrupt_record``), then projected, cast and given their lineage; the
    source of a row is its file (its folder, in this result)."""
    root = scratch_path(spark, "landing")
    m = _topics(spark, sf, ["weather"]).filter(F.col("value").isNotNull())
    m.select(F.make_valid_utf8(F.col("value").cast("string")).alias("value")).write.mode("overwrite").text(f"{root}/weather")
    d = _msgs(spark, sf, ["demand"]).filter(F.col("error_message").isNull())
    B.write_seed_csv(DC.project_to_schema(d, "demand").drop(*DC.PASS), f"{root}/operator")
    schema = ", ".join(f"`{c}` string" for c in [*LANDING_FIELDS, "_corrupt_record"])
    weather = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").option(
        "allowSingleQuotes", "false").json(f"{root}/weather")
    names = [n for n, _, _ in schemas.BRONZE_COLUMNS["demand"]] + ["_dataset"]
    operator = spark.read.schema(", ".join(f"`{c}` string" for c in names)).option("header", True).csv(f"{root}/operator")
    out = None
    for feed, table, df in (("weather", "weather", weather), ("operator", "demand", operator)):
        bad = F.col("_corrupt_record").isNotNull() if feed == "weather" else F.lit(False)
        payload = F.create_map(*[x for c in df.columns if c != "_corrupt_record" for x in (F.lit(c), F.when(~bad, F.col(c)))])
        rows = df.select(F.col("_metadata.file_path").alias("topic"), F.lit(None).cast("int").alias("partition"),
                         F.lit(None).cast("long").alias("offset"), F.lit(None).cast("binary").alias("key"),
                         bad.cast("string").alias("value_text"), payload.alias("p"))
        typed = DC.cast_typed(DC.project_to_schema(DC.normalize_ppa(DC.normalize_currency(rows)), table), table)
        e = DC.enrich_meta(typed, BATCH, with_offsets=False, ts_col=None)
        corrupt = F.col("value_text") == "true"
        part = e.select(F.lit(feed).alias("feed"), "node_id", F.col(B.METRIC[table]).alias("metric"), corrupt.alias("is_corrupt"),
                        (F.col("is_good") & ~corrupt).alias("is_good"), F.element_at(F.split("_source", "/"), -2).alias("_source"), "_dataset")
        out = part if out is None else out.unionByName(part)
    for feed, (topic, metric, digit) in L.FEEDS.items():
        d = _msgs(spark, sf, [topic]).filter(F.col("error_message").isNull())
        rows = d.select("offset", F.col("p.node_id").alias("node_id"), F.col(f"p.{metric}").alias("metric"),
                        F.col("p._dataset").alias("_dataset"), (M.payload_k(F.col("value")) % 10 == digit).alias("damaged"))
        L.write(feed, rows, f"{root}/{feed}")
        read = L.read(spark, feed, f"{root}/{feed}")
        good = ~F.col("is_corrupt") & F.col("node_id").isNotNull() & F.col("metric").isNotNull()
        out = out.unionByName(read.select(F.lit(feed).alias("feed"), "node_id", "metric", "is_corrupt", good.alias("is_good"),
                                          F.element_at(F.split("file", "/"), -2).alias("_source"),
                                          F.coalesce("_dataset", F.lit("unknown")).alias("_dataset")))
    return out


_SEEDS_SQL = MSG_SQL + f"""
SELECT CASE topic {' '.join(f"WHEN '{t}' THEN '{b}'" for t, b in schemas.TOPIC_TABLE.items())} END AS table_name,
       CASE WHEN event_type <> 'error' THEN strftime(ts, {ISO_SQL}) END AS timestamp,
       CASE WHEN k <> {FK['no_node']} THEN 'N' || user_id END AS node_id,
       CASE WHEN k = {FK['bad_number']} THEN 'n/a' ELSE CAST(mw AS VARCHAR) END AS metric
FROM mm WHERE error_message IS NULL"""


@register("seed_csv_roundtrip", _SEEDS_SQL, "S1 S2")
def seed_csv_roundtrip(spark, sf):
    """The five seed files: each table's payloads written as header CSV, then read back all-STRING."""
    root = scratch_path(spark, "seeds")
    d = DC.normalize_ppa(DC.normalize_currency(_msgs(spark, sf).filter(F.col("error_message").isNull())))
    out = None
    for topic, table in schemas.TOPIC_TABLE.items():
        seed = DC.project_to_schema(d.filter(F.col("topic") == topic), table).drop(*DC.PASS)
        B.write_seed_csv(seed, f"{root}/{table}")
        back = B.read_seed_csv(spark, f"{root}/{table}", seed.columns)
        at = F.col("timestamp") if "timestamp" in back.columns else F.lit(None).cast("string")
        part = back.select(F.lit(table).alias("table_name"), at.alias("timestamp"), "node_id", F.col(B.METRIC[table]).alias("metric"))
        out = part if out is None else out.unionByName(part)
    return out
