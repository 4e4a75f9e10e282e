"""Join queries (J1-J3, J7, J8, J10-J12, L1, A19, U2) bound to the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattline.functions.columns import dround, exact_sum, hour_ts
from wattline.operators import gold
from wattline.operators import joins as J
from wattline.plans import derive_plans
from wattline.plans.registry import register
from wattline.plans.sqlparts import day_of, num, xs
from wattline.plans.sqlparts import dround as sround
from wattline.plans.sqlparts import hour_ts as sql_hour
from wattline.plans.views import with_views
from wattline.session import materialized, scratch_path
from wattline.sources import tables as T


@register("dispatch_join", with_views("generation", "plants", "demand", extra=f"""
gnd AS (SELECT node_id, {day_of('g.ts')} AS day, {xs('mwh', 2)} AS generation_mwh, true AS in_a
        FROM generation g JOIN plants p USING (plant_id) GROUP BY 1, 2),
dnd AS (SELECT node_id, {day_of('ts')} AS day, {xs('demand_mw', 6)} AS demand_mwh, true AS in_b
        FROM demand GROUP BY 1, 2)""") + """
SELECT node_id, day, generation_mwh, demand_mwh,
       CASE WHEN in_a AND in_b THEN 'both' WHEN in_a THEN 'left_only' ELSE 'right_only' END AS match
FROM gnd FULL OUTER JOIN dnd USING (node_id, day)""", "J2")
def dispatch_join(spark, sf):
    g = gold.node_day_generation(T.generation(spark, sf), T.plants(spark, sf)).drop("curtailed_mwh")
    d = gold.node_day_demand(T.demand(spark, sf))
    return J.full_outer(g, d, ["node_id", "day"])


@register("node_mapping", derive_plans.SCENARIO_SQL + """
SELECT s.node_id AS base_node, node_name AS base_name, A_cap AS base_a, N_cap AS base_n, R_cap AS base_r, base_demand,
       ff_id AS ff_node, ff_name, ff_climate, ff_A_cap AS ff_a, ff_N_cap AS ff_n, ff_R_cap AS ff_r, CAST(0 AS BIGINT) AS ff_geo,
       ff_tidal, ff_demand, divergence_note, demand_traits
FROM s JOIN nodes ON s.node_id = nodes.node_id""", "J1")
def node_mapping(spark, sf):
    """Base and derived nodes side by side, 17 columns.  Both sides and the mapping (25 nodes) are
    evaluated once, then paired strictly."""
    s = materialized(derive_plans.scenario(spark, sf), "scenario")
    base = s.select("node_id", "A_cap", "N_cap", "R_cap", "base_demand").join(F.broadcast(T.nodes(spark, sf)), "node_id")
    mapping = materialized(derive_plans.scenario_mapping(spark, sf).select(
        F.col("node_id").alias("base_id"), F.col("ff_id").alias("ff_ref"), "ff_name", "ff_climate", "divergence_note", "demand_traits"), "mapping")
    derived = s.select("ff_id", "ff_A_cap", "ff_N_cap", "ff_R_cap", "ff_tidal", "ff_demand")
    j = J.strict_pairing(base, mapping, derived, "node_id", "base_id", "ff_ref", "ff_id")
    return j.select(F.col("node_id").alias("base_node"), F.col("node_name").alias("base_name"), F.col("A_cap").alias("base_a"),
                    F.col("N_cap").alias("base_n"), F.col("R_cap").alias("base_r"), "base_demand", F.col("ff_id").alias("ff_node"),
                    "ff_name", "ff_climate", F.col("ff_A_cap").alias("ff_a"), F.col("ff_N_cap").alias("ff_n"),
                    F.col("ff_R_cap").alias("ff_r"), F.lit(0).cast("long").alias("ff_geo"), "ff_tidal", "ff_demand",
                    "divergence_note", "demand_traits")


@register("weather_join", with_views("telemetry", extra=f"""
w AS (SELECT node_id, {sql_hour('ts')} AS hour, {sround(f"{xs('mw', 4)} / COUNT(mw)", 4)} AS weather_mw
      FROM telemetry WHERE source_type = 'view' GROUP BY 1, 2)""") + f"""
SELECT msg_offset, t.node_id, ts, mw, weather_mw
FROM telemetry t LEFT JOIN w ON t.node_id = w.node_id AND {sql_hour('t.ts')} = w.hour
WHERE source_type <> 'view'""", "J3")
def weather_join(spark, sf):
    t = T.telemetry(spark, sf)
    w = (t.filter(F.col("source_type") == "view").groupBy("node_id", hour_ts("ts").alias("hour"))
         .agg(dround(exact_sum("mw", 4) / F.count("mw"), 4).alias("weather_mw")))
    w = materialized(w, "weather_hours")     # a plain scan, so that Spark can split a hot node of the rows
    s = t.filter(F.col("source_type") != "view").select("msg_offset", "node_id", "ts", "mw",
                                                         hour_ts("ts").alias("hour"))
    return s.join(w, ["node_id", "hour"], "left").select("msg_offset", "node_id", "ts", "mw", "weather_mw")


@register("cross_reference", with_views("telemetry", "plants") + """
SELECT node_id, COUNT(*) AS n_samples FROM telemetry t
WHERE NOT EXISTS (SELECT 1 FROM plants p WHERE p.plant_id = t.node_id) GROUP BY 1""", "J7 V9")
def cross_reference(spark, sf):
    n = T.telemetry(spark, sf).groupBy("node_id").agg(F.count(F.lit(1)).alias("n_samples"))
    p = T.plants(spark, sf).select(F.col("plant_id").alias("node_id"))
    return J.anti(n, p, ["node_id"])


@register("node_coverage", with_views("telemetry", "plants") + """
SELECT plant_id, plant_name, EXISTS (SELECT 1 FROM telemetry t WHERE t.node_id = p.plant_id) AS is_covered
FROM plants p""", "J8 V9")
def node_coverage(spark, sf):
    p = T.plants(spark, sf).select("plant_id", "plant_name")
    return J.coverage(p, T.telemetry(spark, sf), "plant_id", "node_id")


@register("bus_join", with_views("plants") + """
, bus AS (SELECT 'BUS_' || r_name AS bus_id, 110 + 10 * r_regionkey AS voltage_kv FROM region)
SELECT plant_id, cen_barra, voltage_kv FROM (
  SELECT plant_id, CASE WHEN acctbal >= 0 THEN 'BUS_' || region END AS cen_barra FROM plants) p
LEFT JOIN bus ON p.cen_barra = bus.bus_id""", "J10")
def bus_join(spark, sf):
    p = T.plants(spark, sf).select(
        "plant_id", F.when(F.col("acctbal") >= 0, F.concat(F.lit("BUS_"), F.col("region"))).alias("cen_barra"))
    r = T.scan(spark, sf, "region")
    bus = J.broadcast_if_small(r.select(F.concat(F.lit("BUS_"), F.col("r_name")).alias("cen_barra"),
                                        (F.lit(110) + F.lit(10) * F.col("r_regionkey")).alias("voltage_kv")))
    return p.join(bus, "cen_barra", "left").select("plant_id", "cen_barra", "voltage_kv")


UPDATE_FROM = "1998-06-01 00:00:00"
# The generated line numbers repeat inside an order, so the upsert key is the full line identity.
LINE_KEY = ["gen_order", "gen_line", "plant_id", "asset_id", "ts", "mwh"]


@register("merge_upsert", with_views("generation") + f"""
, u AS (
  SELECT {', '.join(LINE_KEY)}, CAST(year(ts) AS INTEGER) AS year, revenue, 'target' AS version,
         TIMESTAMP '2024-01-01 00:00:00' AS _loaded_at FROM generation WHERE status = 'F'
  UNION ALL
  SELECT {', '.join(LINE_KEY)}, CAST(year(ts) AS INTEGER), {sround(f'revenue * {num(1.01)}', 2)}, 'source',
         TIMESTAMP '2024-02-01 00:00:00' FROM generation WHERE ts >= TIMESTAMP '{UPDATE_FROM}')
SELECT gen_order, gen_line, plant_id, year, revenue, version FROM (
  SELECT *, row_number() OVER (PARTITION BY {', '.join(LINE_KEY)} ORDER BY _loaded_at DESC) AS rn FROM u)
WHERE rn = 1""", "J12 W1 S19")
def merge_upsert(spark, sf):
    """Upsert on a Parquet table partitioned by year: only the years the source touches are read
    (a semi join on the touched years prunes partitions), merged, staged, and written back with
    dynamic partition overwrite; untouched years are not rewritten."""
    g = T.generation(spark, sf)
    cols = [*LINE_KEY, F.year("ts").alias("year")]
    target = g.filter(F.col("status") == "F").select(*cols, "revenue", F.lit("target").alias("version"),
                                                      F.lit("2024-01-01 00:00:00").cast("timestamp").alias("_loaded_at"))
    source = g.filter(F.col("ts") >= F.lit(UPDATE_FROM).cast("timestamp_ntz")).select(
        *cols, dround(F.col("revenue") * F.lit(1.01), 2).alias("revenue"), F.lit("source").alias("version"),
        F.lit("2024-02-01 00:00:00").cast("timestamp").alias("_loaded_at"))
    table = scratch_path(spark, "merge_target")
    target.write.mode("overwrite").partitionBy("year").parquet(table)
    current = spark.read.parquet(table)
    touched = J.broadcast_if_small(source.select("year").distinct(), 100_000)
    merged = J.merge_upsert(current.join(touched, "year", "left_semi"), source.select(*current.columns),
                            LINE_KEY, ["_loaded_at"])
    stage = scratch_path(spark, "merge_stage")
    merged.write.mode("overwrite").partitionBy("year").parquet(stage)
    (spark.read.parquet(stage).select(*current.columns).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(table))
    return spark.read.parquet(table).select("gen_order", "gen_line", "plant_id", "year", "revenue", "version")


_RECON_SQL = with_views("assets", extra="""
d AS (SELECT asset_id, asset_name AS description, make AS list_id, [model, 'size-' || size_class] AS labels FROM assets),
c AS (SELECT asset_id,
             CASE WHEN size_class > 45 THEN asset_name || ' (old)' ELSE asset_name END AS description,
             CASE WHEN size_class = 20 THEN 'Brand#0' ELSE make END AS list_id,
             CASE WHEN size_class BETWEEN 10 AND 12 THEN ['size-' || size_class, model]
                  ELSE [model, 'size-' || size_class] END AS labels
      FROM assets WHERE size_class >= 3),
j AS (SELECT COALESCE(d.asset_id, c.asset_id) AS asset_id, d.asset_id IS NOT NULL AS dp, c.asset_id IS NOT NULL AS cp,
             list_filter([CASE WHEN d.description IS DISTINCT FROM c.description THEN 'description' END,
                          CASE WHEN d.list_id IS DISTINCT FROM c.list_id THEN 'list_id' END,
                          CASE WHEN list_sort(list_distinct(d.labels)) IS DISTINCT FROM list_sort(list_distinct(c.labels))
                               THEN 'labels' END], lambda x: x IS NOT NULL) AS diffs
      FROM d FULL OUTER JOIN c ON d.asset_id = c.asset_id),
r AS (SELECT asset_id, CASE WHEN NOT cp THEN 'created' WHEN NOT dp THEN 'orphan'
                            WHEN len(diffs) > 0 THEN 'updated' ELSE 'unchanged' END AS outcome,
             CASE WHEN dp AND cp THEN diffs ELSE []::VARCHAR[] END AS changed_columns FROM j)""")


def _desired_current(spark, sf):
    a = T.assets(spark, sf)
    size = F.concat(F.lit("size-"), F.col("size_class").cast("string"))
    d = a.select("asset_id", F.col("asset_name").alias("description"), F.col("make").alias("list_id"),
                 F.array("model", size).alias("labels"))
    c = a.filter(F.col("size_class") >= 3).select(
        "asset_id",
        F.when(F.col("size_class") > 45, F.concat("asset_name", F.lit(" (old)"))).otherwise(F.col("asset_name"))
        .alias("description"),
        F.when(F.col("size_class") == 20, F.lit("Brand#0")).otherwise(F.col("make")).alias("list_id"),
        F.when(F.col("size_class").between(10, 12), F.array(size, F.col("model"))).otherwise(F.array("model", size))
        .alias("labels"))
    return d, c


@register("reconcile", _RECON_SQL + "SELECT * FROM r", "J11 U2")
def reconcile(spark, sf):
    d, c = _desired_current(spark, sf)
    return J.reconcile(d, c, "asset_id", ["description", "list_id", "labels"], set_cols=["labels"])


@register("reconcile_summary", _RECON_SQL + "SELECT outcome, COUNT(*) AS n FROM r GROUP BY 1", "A19")
def reconcile_summary(spark, sf):
    return reconcile(spark, sf).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@register("prefix_lookup", with_views("assets", extra="""
lists AS (SELECT model AS list_name, MIN(asset_id) AS position FROM assets GROUP BY 1),
w AS (SELECT DISTINCT split_part(asset_name, ' ', 1) AS word FROM assets),
declared AS (SELECT word AS declared_name FROM w UNION SELECT word || 'est' FROM w),
ex AS (SELECT declared_name, arg_min(list_name, position) AS e FROM declared JOIN lists
       ON lower(declared_name) = lower(list_name) GROUP BY 1),
pr AS (SELECT declared_name, arg_min(list_name, position) AS p FROM declared JOIN lists
       ON substring(trim(lower(declared_name)), 1, 4) = substring(trim(lower(list_name)), 1, 4)
       WHERE substring(trim(lower(declared_name)), 1, 4) <> '' GROUP BY 1)""") + """
SELECT declared_name, COALESCE(e, p) AS list_name,
       CASE WHEN e IS NOT NULL THEN 'exact' WHEN p IS NOT NULL THEN 'prefix' ELSE 'error' END AS match_kind
FROM declared LEFT JOIN ex USING (declared_name) LEFT JOIN pr USING (declared_name)""", "L1 F3")
def prefix_lookup(spark, sf):
    a = T.assets(spark, sf)
    lists = a.groupBy(F.col("model").alias("list_name")).agg(F.min("asset_id").alias("position"))
    w = a.select(F.split("asset_name", " ")[0].alias("word")).distinct()
    declared = w.select(F.col("word").alias("declared_name")).unionByName(
        w.select(F.concat("word", F.lit("est")).alias("declared_name"))).distinct()
    return J.prefix_lookup(declared, lists)
