"""Gold facts and report queries bound to the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattline.functions.columns import day, exact_avg, hour_ts
from wattline.operators import gold
from wattline.plans.registry import register
from wattline.plans.sqlparts import day_of, hour_of, month_of, num, ratio, xs
from wattline.plans.sqlparts import hour_ts as sql_hour
from wattline.plans.views import with_views
from wattline.sources import tables as T

# Fixed values of the bindings: the five source types of the telemetry view (event_type domain) and
# the five owners of the workload view (order priorities).
SOURCES = ["click", "error", "purchase", "signup", "view"]
OWNERS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
CARBON_FACTOR = 0.42
LCOE_RATE = 0.07
# Bindings of values that the driver's tables lack: a plant's contract price and a node's latitude.
PPA_SQL = "(40 + p.plant_id % 20)"
LATITUDE_SQL = "(CAST(60 - (node_id * 7) % 25 * 4 AS DOUBLE))"


def ppa_price(plant_id):
    return F.lit(40) + plant_id % 20


def latitude(node_id):
    return (F.lit(60) - (node_id * 7) % 25 * 4).cast("double")


@register("fact_revenue_region_month", with_views("generation", "plants") + f"""
SELECT region, {month_of('g.ts')} AS month, {xs('mwh', 2)} AS mwh, {xs('revenue', 2)} AS revenue,
       {xs(f'mwh * {PPA_SQL}', 2)} AS ppa_revenue, {xs('revenue * (1 + spot_adj)', 4)} AS spot_revenue,
       COUNT(*) AS n_rows, {ratio(xs('revenue', 2), xs('mwh', 2))} AS blended_price
FROM generation g JOIN plants p USING (plant_id)
GROUP BY 1, 2""", "A9 J6")
def fact_revenue_region_month(spark, sf):
    plants = T.plants(spark, sf).withColumn("ppa_price", ppa_price(F.col("plant_id")))
    return gold.fact_revenue(T.generation(spark, sf), plants, ["region"], "month")


@register("fact_generation_plant_hour", with_views("telemetry", "plants", extra=f"""
h AS (SELECT node_id AS plant_id, {sql_hour('ts')} AS hour, COUNT(mw) AS samples,
             {xs('mw', 4)} AS mw_sum, COUNT_IF(mw > 0) AS positive
      FROM telemetry GROUP BY 1, 2)""") + f"""
SELECT h.plant_id, hour, samples, mw_sum / samples AS mwh,
       LEAST({num(1.0)}, positive / {num(12.0)}) AS availability,
       {ratio('mw_sum / samples', 'capacity_mw')} AS capacity_factor
FROM h LEFT JOIN plants p ON h.plant_id = p.plant_id""", "A8")
def fact_generation_plant_hour(spark, sf):
    s = T.telemetry(spark, sf).withColumnRenamed("node_id", "plant_id")
    return gold.fact_generation(s, T.plants(spark, sf), feed_seconds=300)


_GEN_ND = f"""gnd AS (SELECT node_id, {day_of('g.ts')} AS day, {xs('mwh', 2)} AS generation_mwh,
                   {xs('curtailed', 4)} AS curtailed_mwh
            FROM generation g JOIN plants p USING (plant_id) GROUP BY 1, 2),
dnd AS (SELECT node_id, {day_of('ts')} AS day, {xs('demand_mw', 6)} AS demand_mwh
        FROM demand GROUP BY 1, 2)"""


@register("fact_dispatch_node_day", with_views("generation", "plants", "demand", extra=_GEN_ND) + f"""
SELECT node_id, day, generation_mwh, curtailed_mwh, demand_mwh,
       {ratio('curtailed_mwh', 'generation_mwh')} AS curtailment_rate,
       COALESCE(generation_mwh, {num(0.0)}) - COALESCE(demand_mwh, {num(0.0)}) AS net_balance_mwh
FROM gnd FULL OUTER JOIN dnd USING (node_id, day)""", "A10 J2 P8")
def fact_dispatch_node_day(spark, sf):
    g = gold.node_day_generation(T.generation(spark, sf), T.plants(spark, sf))
    d = gold.node_day_demand(T.demand(spark, sf))
    return gold.fact_dispatch(g, d)


@register("fact_carbon_node_month", with_views("generation", "plants") + f"""
SELECT node_id, {month_of('g.ts')} AS month, {xs('mwh', 2)} AS mwh,
       {xs('mwh', 2)} * {num(CARBON_FACTOR)} AS tco2e_avoided
FROM generation g JOIN plants p USING (plant_id) GROUP BY 1, 2""", "A11 P12")
def fact_carbon_node_month(spark, sf):
    return gold.fact_carbon(T.generation(spark, sf), T.plants(spark, sf), CARBON_FACTOR)


@register("asset_health", with_views("telemetry", extra=f"""
hu AS (SELECT node_id, {sql_hour('ts')} AS hour, bool_or(mw > 0) AS up FROM telemetry GROUP BY 1, 2)""") + f"""
SELECT node_id, {day_of('hour')} AS day, COUNT_IF(up) AS hours_up,
       COUNT_IF(up) * {num(100.0)} / {num(24.0)} AS uptime_pct
FROM hu GROUP BY 1, 2""", "A12")
def asset_health(spark, sf):
    return gold.asset_health(T.telemetry(spark, sf))


@register("lcoe_by_plant", with_views("generation", extra=f"""
py AS (SELECT plant_id, CAST(year(ts) AS INTEGER) AS year, {xs('revenue * spot_adj', 6)} AS cost,
              {xs('mwh', 2)} AS mwh
       FROM generation GROUP BY 1, 2),
pd AS (SELECT plant_id, cost, mwh,
              pow({num(1.0 + LCOE_RATE)}, year - MIN(year) OVER (PARTITION BY plant_id)) AS disc FROM py),
d AS (SELECT plant_id, CAST(cost / disc AS DECIMAL(30,4)) AS dcost,
             CAST(mwh / disc AS DECIMAL(30,4)) AS dmwh FROM pd)""") + f"""
SELECT plant_id, CAST(SUM(dcost) AS DOUBLE) AS discounted_cost, CAST(SUM(dmwh) AS DOUBLE) AS discounted_mwh,
       round({ratio('CAST(SUM(dcost) AS DOUBLE)', 'CAST(SUM(dmwh) AS DOUBLE)')}, 6) AS lcoe
FROM d GROUP BY 1""", "A12")
def lcoe_by_plant(spark, sf):
    return gold.lcoe(T.generation(spark, sf), LCOE_RATE)


@register("system_totals", with_views("generation", "demand") + f"""
SELECT g.generation_mwh, g.curtailed_mwh, d.demand_mwh,
       g.generation_mwh * {num(CARBON_FACTOR)} AS tco2e_avoided,
       g.generation_mwh - d.demand_mwh AS net_balance_mwh
FROM (SELECT {xs('mwh', 2)} AS generation_mwh, {xs('curtailed', 4)} AS curtailed_mwh FROM generation) g,
     (SELECT {xs('demand_mw', 6)} AS demand_mwh FROM demand) d""", "A3")
def system_totals(spark, sf):
    return gold.system_totals(T.generation(spark, sf), T.demand(spark, sf), CARBON_FACTOR)


_hp_cols = ",\n       ".join(
    f"CAST(SUM(CASE WHEN source_type = '{s}' THEN CAST(mw AS DECIMAL(28,4)) END) AS DOUBLE) AS mw_{s}"
    for s in SOURCES)


@register("hourly_profile", with_views("telemetry") + f"""
SELECT {hour_of('ts')} AS hour,
       CAST(SUM(CASE WHEN source_type IN ({', '.join(repr(s) for s in SOURCES)})
                     THEN CAST(mw AS DECIMAL(28,4)) END) AS DOUBLE) AS total_mw,
       {_hp_cols}
FROM telemetry GROUP BY 1""", "A4")
def hourly_profile(spark, sf):
    return gold.hourly_profile(T.telemetry(spark, sf), SOURCES)


@register("mix_by_node", with_views("telemetry") + f"""
, a AS (SELECT node_id, source_type, {xs('mw', 4)} AS mw FROM telemetry GROUP BY 1, 2),
t AS (SELECT node_id, {xs('mw', 4)} AS total FROM telemetry GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY total DESC, node_id) AS node_rank FROM t)
SELECT a.node_id, source_type, mw, round(mw / total, 6) AS share, node_rank FROM a JOIN r USING (node_id)""", "A5 W6")
def mix_by_node(spark, sf):
    return gold.mix_by_node(T.telemetry(spark, sf))


@register("capacity_vs_demand", with_views("plants", "demand", extra=f"""
cap AS (SELECT node_id, node_name, region, {xs('capacity_mw', 2)} AS capacity_mw FROM plants GROUP BY 1, 2, 3),
dd AS (SELECT node_id, {day_of('ts')} AS day, {xs('demand_mw', 6)} AS demand_mwh FROM demand GROUP BY 1, 2),
d AS (SELECT node_id, MAX(demand_mwh) AS peak_demand_mwh, round(AVG(demand_mwh), 6) AS avg_demand_mwh
      FROM dd GROUP BY 1)""") + f"""
, l AS (SELECT *, {LATITUDE_SQL} AS latitude FROM cap)
SELECT l.node_id, node_name, region, latitude, capacity_mw, peak_demand_mwh, avg_demand_mwh,
       row_number() OVER (ORDER BY latitude DESC, l.node_id) AS north_rank
FROM l LEFT JOIN d ON l.node_id = d.node_id
ORDER BY north_rank""", "A6 O1")
def capacity_vs_demand(spark, sf):
    plants = T.plants(spark, sf).withColumn("latitude", latitude(F.col("node_id")))
    return gold.capacity_vs_demand(plants, T.demand(spark, sf))


@register("node_revenue", with_views("generation", "plants") + f"""
SELECT node_id, {xs('revenue', 2)} AS revenue, {xs('revenue * curtail_rate', 6)} AS curtailment_cost
FROM generation g JOIN plants p USING (plant_id) GROUP BY 1""", "A7 P11")
def node_revenue(spark, sf):
    return gold.node_revenue(T.generation(spark, sf), T.plants(spark, sf))


_hm_cols = ",\n       ".join(
    f"CAST(SUM(CASE WHEN hour(ts) = {h} THEN CAST(mw AS DECIMAL(28,4)) END) AS DOUBLE)"
    f" / COUNT(CASE WHEN hour(ts) = {h} THEN mw END) AS h{h:02d}" for h in range(24))


@register("heatmap_node_hour", with_views("telemetry") + f"""
SELECT node_id,
       {_hm_cols}
FROM telemetry GROUP BY 1""", "A18")
def heatmap_node_hour(spark, sf):
    return gold.heatmap(T.telemetry(spark, sf))


@register("rollup_region_node_day", with_views("generation", "plants") + f"""
SELECT region, node_id, {day_of('g.ts')} AS day, {xs('mwh', 2)} AS mwh, {xs('revenue', 2)} AS revenue,
       GROUPING_ID(region, node_id, {day_of('g.ts')}) AS gid
FROM generation g JOIN plants p USING (plant_id)
GROUP BY ROLLUP (region, node_id, {day_of('g.ts')})""", "A17")
def rollup_region_node_day(spark, sf):
    return gold.rollup_region_node_day(T.generation(spark, sf), T.plants(spark, sf))


@register("cube_source_status", with_views("generation") + f"""
SELECT status, flag, {xs('mwh', 2)} AS mwh, COUNT(*) AS n_rows, GROUPING_ID(status, flag) AS gid
FROM generation GROUP BY CUBE (status, flag)""", "A17")
def cube_source_status(spark, sf):
    return gold.cube_status(T.generation(spark, sf))


@register("grouping_sets_billing", with_views("generation", "plants") + f"""
SELECT region, node_id, {month_of('g.ts')} AS month, {xs('revenue', 2)} AS revenue,
       GROUPING_ID(region, node_id, {month_of('g.ts')}) AS gid
FROM generation g JOIN plants p USING (plant_id)
GROUP BY GROUPING SETS ((region, {month_of('g.ts')}), (node_id, {month_of('g.ts')}), ())""", "A17")
def grouping_sets_billing(spark, sf):
    return gold.grouping_sets_billing(T.generation(spark, sf), T.plants(spark, sf))


@register("month_to_date_revenue", with_views("generation", "plants", extra=f"""
nd AS (SELECT node_id, {day_of('g.ts')} AS day, {xs('revenue', 2)} AS revenue
       FROM generation g JOIN plants p USING (plant_id) GROUP BY 1, 2)""") + """
SELECT node_id, day, revenue,
       CAST(SUM(CAST(revenue AS DECIMAL(28,2))) OVER (
            PARTITION BY node_id, date_trunc('month', day) ORDER BY day
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS mtd_revenue
FROM nd""", "W7")
def month_to_date_revenue(spark, sf):
    g = T.generation(spark, sf).select("plant_id", day("ts").alias("day"), "revenue")
    nd = (g.join(T.plants(spark, sf).select("plant_id", "node_id"), "plant_id")
          .groupBy("node_id", "day").agg(gold.exact_sum("revenue", 2, "revenue")))
    return gold.month_to_date(nd, "node_id", "revenue")


@register("topk_curtailment", with_views("generation", "plants", extra=f"""
pc AS (SELECT region, plant_id, {xs('curtailed', 4)} AS curtailed_mwh
       FROM generation g JOIN plants p USING (plant_id) GROUP BY 1, 2)""") + """
SELECT * FROM (
  SELECT region, plant_id, curtailed_mwh,
         CAST(row_number() OVER (PARTITION BY region ORDER BY curtailed_mwh DESC, plant_id) AS INTEGER) AS rank
  FROM pc) WHERE rank <= 3""", "O4")
def topk_curtailment(spark, sf):
    g = T.generation(spark, sf).select("plant_id", "curtailed")
    pc = (g.join(T.plants(spark, sf).select("plant_id", "region"), "plant_id")
          .groupBy("region", "plant_id").agg(gold.exact_sum("curtailed", 4, "curtailed_mwh")))
    return gold.top_k(pc, "region", [F.col("curtailed_mwh").desc(), F.col("plant_id")], 3)


def _hourly_node_mw(spark, sf):
    t = T.telemetry(spark, sf)
    return t.groupBy("node_id", hour_ts("ts").alias("hour")).agg(exact_avg("mw", 4).alias("mw"))


_HOURLY_SQL = f"""hn AS (SELECT node_id, {sql_hour('ts')} AS hour,
                   {xs('mw', 4)} / COUNT(mw) AS mw FROM telemetry GROUP BY 1, 2)"""


@register("generation_forecast", with_views("telemetry", extra=_HOURLY_SQL + f""",
h AS (SELECT node_id, {day_of('hour')} AS day, hour(hour) AS hod, mw FROM hn),
f AS (SELECT *, AVG(mw) OVER (PARTITION BY node_id, hod ORDER BY date_diff('day', DATE '1970-01-01', day)
                              RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING) AS forecast FROM h)""") + """
SELECT node_id, COUNT(*) AS n_points, round(AVG(abs(mw - forecast) / abs(mw)), 4) AS mape
FROM f
WHERE day > (SELECT MAX(CAST(hour AS DATE)) FROM hn) - INTERVAL 3 DAY
  AND forecast IS NOT NULL AND mw <> 0
GROUP BY 1""", "A22")
def generation_forecast(spark, sf):
    return gold.seasonal_naive_forecast(_hourly_node_mw(spark, sf), k_days=7, holdout_days=3)


@register("success_rate", with_views("telemetry") + f"""
SELECT {day_of('ts')} AS day, COUNT(*) AS runs, COUNT_IF(source_type <> 'error') AS succeeded,
       COUNT_IF(source_type <> 'error') / COUNT(*) AS success_rate,
       CASE WHEN COUNT_IF(source_type <> 'error') / COUNT(*) >= {num(0.95)} THEN 'pass' ELSE 'fail' END AS verdict
FROM telemetry GROUP BY 1""", "A21")
def success_rate(spark, sf):
    runs = T.telemetry(spark, sf).select(
        "ts", F.when(F.col("source_type") == "error", "failed").otherwise("success").alias("status"))
    return gold.success_rate(runs, 0.95)


# Fixed budget band per service (region of the generation view), in currency units.
BUDGET = [("AFRICA", 1000.0, 2500.0), ("AMERICA", 1000.0, 2500.0), ("ASIA", 1000.0, 2500.0),
          ("EUROPE", 1000.0, 2500.0)]
_budget_sql = " UNION ALL ".join(
    f"SELECT '{s}' AS service, {num(lo)} AS budget_low, {num(hi)} AS budget_high" for s, lo, hi in BUDGET)


@register("cost_vs_budget", with_views("generation", "plants", extra=f"""
b AS ({_budget_sql}),
a AS (SELECT region AS service, {xs('revenue * spot_adj * curtail_rate', 8)} AS actual
      FROM generation g JOIN plants p USING (plant_id) GROUP BY 1)""") + """
SELECT a.service, actual, budget_low, budget_high,
       CASE WHEN budget_high IS NULL THEN 'no_budget' WHEN actual > budget_high THEN 'over'
            WHEN actual < budget_low THEN 'under' ELSE 'within' END AS status
FROM a LEFT JOIN b ON a.service = b.service""", "A23")
def cost_vs_budget(spark, sf):
    g = T.generation(spark, sf)
    costs = (g.join(T.plants(spark, sf).select("plant_id", "region"), "plant_id")
             .select(F.col("region").alias("service"),
                     (F.col("revenue") * F.col("spot_adj") * F.col("curtail_rate")).alias("cost")))
    budget = spark.createDataFrame(BUDGET, "service string, budget_low double, budget_high double")
    return gold.cost_vs_budget(costs, budget, scale=8)


_wp_cols = ",\n       ".join(
    f"CAST(COALESCE(SUM(CASE WHEN o_orderpriority = '{o}' THEN CAST(ceil(o_totalprice / 100000) AS BIGINT) END), 0)"
    f" AS BIGINT) AS pts_{i}" for i, o in enumerate(OWNERS))
_wp_total = " + ".join(f"pts_{i}" for i in range(len(OWNERS)))


@register("workload_pivot", f"""
SELECT *, {_wp_total} AS total FROM (
SELECT CAST(year(o_orderdate) AS INTEGER) AS sprint,
       {_wp_cols}
FROM orders GROUP BY 1)""", "A24")
def workload_pivot(spark, sf):
    o = T.scan(spark, sf, "orders")
    tasks = o.select(F.year("o_orderdate").alias("sprint"), F.col("o_orderpriority").alias("owner"),
                     F.ceil(F.col("o_totalprice") / 100000).alias("points"))
    return gold.workload_pivot(tasks, OWNERS)
