"""Operational queries (A13-A15, D5) bound to the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattline import schemas
from wattline.operators import decode as DC
from wattline.operators import joins as J
from wattline.operators import ops as O
from wattline.plans import bronze_plans, layout_plans
from wattline.plans.registry import register
from wattline.plans.views import with_views
from wattline.session import materialized
from wattline.sources import bronze as B
from wattline.sources import tables as T

AS_OF = "2024-02-01T00:00:00"


def incident_log(spark, sf):
    """Alert log from telemetry: each 'error' sample is an alert of its node (P1 above 300 MW,
    else P2) and each 'purchase' sample of a node closes its P2 incident."""
    t = T.telemetry(spark, sf).filter(F.col("source_type").isin("error", "purchase"))
    is_alert = F.col("source_type") == "error"
    return t.select(
        "ts", F.col("msg_offset").alias("seq"),
        F.concat(F.lit("node N"), F.col("node_id").cast("string"), F.lit(" fault")).alias("title"),
        F.when(is_alert & (F.col("mw") > 300), "P1").otherwise("P2").alias("severity"),
        F.concat(F.lit("mw="), F.col("mw").cast("string")).alias("body"),
        F.when(is_alert, "open").otherwise("close").alias("action"))


_LOG_SQL = with_views("telemetry", extra="""
log AS (SELECT ts, msg_offset AS seq, '[INCIDENT] [' || CASE WHEN source_type = 'error' AND mw > 300 THEN 'P1'
               ELSE 'P2' END || '] node N' || node_id || ' fault' AS full_title,
               'mw=' || CAST(mw AS VARCHAR) AS body, CASE WHEN source_type = 'error' THEN 'open' ELSE 'close' END AS action
        FROM telemetry WHERE source_type IN ('error', 'purchase')),
e AS (SELECT *, CAST(SUM(CASE WHEN action = 'close' THEN 1 ELSE 0 END) OVER (PARTITION BY full_title ORDER BY ts, seq
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - CASE WHEN action = 'close' THEN 1 ELSE 0 END AS BIGINT)
                AS episode FROM log)""")


@register("incident_dedup", _LOG_SQL + """
, c AS (SELECT full_title, episode, MIN(ts) AS opened_at, arg_min(body, (ts, seq)) AS description,
               COUNT(*) - 1 AS n_comments FROM e WHERE action = 'open' GROUP BY 1, 2),
x AS (SELECT full_title, episode, MIN(ts) AS closed_at FROM e WHERE action = 'close' GROUP BY 1, 2)
SELECT c.*, x.closed_at FROM c LEFT JOIN x USING (full_title, episode)""", "A13 F3")
def incident_dedup(spark, sf):
    return O.incident_cards(incident_log(spark, sf)).select(
        "full_title", "episode", "opened_at", "description", "n_comments", "closed_at")


@register("incident_comments", _LOG_SQL + """
, f AS (SELECT full_title, episode, MIN((ts, seq)) AS fs FROM e WHERE action = 'open' GROUP BY 1, 2)
SELECT e.full_title, e.episode, ts, seq, body FROM e JOIN f USING (full_title, episode)
WHERE action = 'open' AND (ts, seq) <> fs""", "A13")
def incident_comments(spark, sf):
    return O.incident_comments(incident_log(spark, sf)).select("full_title", "episode", "ts", "seq", "body")


_STATS = ["telemetry", "generation", "demand"]


_LOADED_SQL = bronze_plans.MSG_SQL[len("WITH "):]
_GOOD = f"error_message IS NULL AND k NOT IN {bronze_plans.ROW_REJECT}"


@register("table_catalog", with_views(*_STATS, extra=_LOADED_SQL) + ", s AS (" + " UNION ALL ".join(
    [f"SELECT '{t}' AS table_name, COUNT(*) AS row_count, MAX(ts) AS freshness FROM {t}" for t in _STATS]
    + [f"SELECT 'bronze.{b}', COUNT(*), {'NULL' if b == 'plants' else 'MAX(ts)'} FROM mm WHERE topic = '{t}' AND {_GOOD}" for t, b in schemas.TOPIC_TABLE.items()]
    + [f"SELECT 'bronze.dead_letter_queue', COUNT(*), NULL FROM mm WHERE NOT ({_GOOD})",
       f"""SELECT 'gold.fact_day', COUNT(*), CAST(MAX(d) AS TIMESTAMP) FROM (
             SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM mm WHERE topic = 'energy.bronze.scada' AND {_GOOD})"""]) + f""")
SELECT '[ASSET] ' || table_name AS title, table_name, row_count, freshness,
       '**Table**: `' || table_name || '`' || chr(10) || chr(10) || '**Row count**: ' || format('{{:,}}', row_count)
       || chr(10) || chr(10) || '**Freshness**: ' || coalesce(strftime(freshness, '%Y-%m-%dT%H:%M:%S'), 'unknown') || chr(10) || chr(10)
       || '**Updated**: {AS_OF}' AS description
FROM s""", "A14")
def table_catalog(spark, sf):
    """Cards of the source views, the Bronze tables of a load, its dead letters and a Gold fact (plants and dead letters
    carry no event time).  The catalog is written, then run again over the grown tables: cards are replaced by title
    (an upsert on the stored catalog), so no card of the first run is left."""
    def loaded():
        root, out = bronze_plans.bronze_root(spark, sf), None
        for name in [*schemas.TOPIC_TABLE.values(), "dead_letter_queue"]:
            t = B.read_table(spark, root, name)
            at = F.max("timestamp").cast("timestamp_ntz") if "timestamp" in t.columns else F.lit(None).cast("timestamp_ntz")
            s = t.agg(F.count(F.lit(1)).alias("row_count"), at.alias("freshness")).select(F.lit(f"bronze.{name}").alias("table_name"), "row_count", "freshness")
            out = s if out is None else out.unionByName(s)
        fact = spark.read.parquet(layout_plans.gold_root(spark, sf) + "/fact_day")
        return out.unionByName(fact.agg(F.count(F.lit(1)).alias("row_count"), F.max("event_date").cast("timestamp_ntz").alias("freshness"))
                               .select(F.lit("gold.fact_day").alias("table_name"), "row_count", "freshness"))

    def stats(cut):
        views = {"telemetry": T.telemetry(spark, sf), "generation": T.generation(spark, sf), "demand": T.demand(spark, sf)}
        out = None
        for name in _STATS:
            rows = views[name] if cut is None else views[name].filter(F.col("ts") < F.lit(cut).cast("timestamp_ntz"))
            s = rows.agg(F.count(F.lit(1)).alias("row_count"), F.max("ts").alias("freshness")).select(
                F.lit(name).alias("table_name"), "row_count", "freshness")
            out = s if out is None else out.unionByName(s)
        return out
    first = materialized(O.table_catalog(stats("1996-01-01 00:00:00"), "1996-01-01T00:00:00").withColumn("_run", F.lit(1)), "catalog")
    second = O.table_catalog(stats(None).unionByName(loaded()), AS_OF).withColumn("_run", F.lit(2))
    return J.merge_upsert(first, second, ["title"], ["_run"]).drop("_run")


@register("nested_snapshot", """
WITH k AS (SELECT l_orderkey, COUNT(*) AS n_children,
                  to_json(list({'l_linenumber': l_linenumber, 'l_quantity': l_quantity, 'l_returnflag': l_returnflag}
                               ORDER BY l_linenumber, l_quantity, l_returnflag)) AS children_json
           FROM lineitem GROUP BY 1)
SELECT o_orderkey, o_orderstatus, 0::BIGINT AS part, COALESCE(n_children, 0) AS n_children,
       CAST(COALESCE(children_json, '[]') AS VARCHAR) AS children_json
FROM orders LEFT JOIN k ON o_orderkey = l_orderkey""", "A15")
def nested_snapshot(spark, sf):
    o = T.scan(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    li = T.scan(spark, sf, "lineitem")
    s = O.nested_snapshot(o, li, "o_orderkey", "l_orderkey", ["l_linenumber", "l_quantity", "l_returnflag"],
                          "l_linenumber")
    return s.select("o_orderkey", "o_orderstatus", "part", F.size("children").cast("long").alias("n_children"),
                    F.to_json("children").alias("children_json"))


@register("lineage_table", bronze_plans.MSG_SQL + f"""
SELECT topic AS _source, '{bronze_plans.BATCH}' AS _batch_id,
       CASE WHEN error_message IS NULL AND k NOT IN {bronze_plans.ROW_REJECT}
            THEN CASE topic {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in schemas.TOPIC_TABLE.items())} END
            ELSE 'dead_letter_queue' END AS table_name,
       COUNT(*) AS rows, MIN("offset") AS min_offset, MAX("offset") AS max_offset
FROM mm GROUP BY 1, 2, 3""", "D5")
def lineage_table(spark, sf):
    names = F.create_map(*[F.lit(x) for kv in schemas.TOPIC_TABLE.items() for x in kv])
    to = F.when(F.col("reject").isNull(), F.element_at(names, F.col("topic"))).otherwise("dead_letter_queue")
    rows = DC.judged(bronze_plans._msgs(spark, sf)).select(
        F.col("topic").alias("_source"), F.lit(bronze_plans.BATCH).alias("_b"), to.alias("_t"), "offset")
    return O.lineage(rows, "_source", "_b", "_t", "offset")
