"""Silver queries (W1-W5, W8, W9, J4, J5, J9, A16) bound to the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattline.functions.columns import dround, exact_sum, hour_ts
from wattline.operators import silver as V
from wattline.plans.registry import register
from wattline.plans.sqlparts import dround as sround
from wattline.plans.sqlparts import hour_ts as sql_hour
from wattline.plans.sqlparts import num, xs
from wattline.plans.views import with_views
from wattline.sources import tables as T

# Fixed values of the bindings: snapshot times of the asset registry and the rules that change it.
SNAPSHOTS = ["1990-01-01 00:00:00", "1998-01-01 00:00:00", "2000-01-01 00:00:00"]


def hourly(spark, sf):
    """Hourly mean MW per node (exact mean, 4 decimals) — the regular series of the silver layer."""
    t = T.telemetry(spark, sf)
    return t.groupBy("node_id", hour_ts("ts").alias("hour")).agg(
        dround(exact_sum("mw", 4) / F.count("mw"), 4).alias("mw"))


HN = f"""hn AS (SELECT node_id, {sql_hour('ts')} AS hour, {sround(f"{xs('mw', 4)} / COUNT(mw)", 4)} AS mw
       FROM telemetry GROUP BY 1, 2)"""


@register("dedup_latest", with_views("generation") + """
SELECT plant_id, ts, gen_order, gen_line, mwh, revenue FROM (
  SELECT *, row_number() OVER (PARTITION BY plant_id, ts ORDER BY gen_order DESC, gen_line DESC) AS rn
  FROM generation) WHERE rn = 1""", "W1 J12")
def dedup_latest(spark, sf):
    g = T.generation(spark, sf)
    return V.dedup_latest(g, ["plant_id", "ts"], ["gen_order", "gen_line"], ["mwh", "revenue"])


@register("gap_detection", with_views("telemetry") + """
SELECT node_id, gap_start, gap_end, gap_us FROM (
  SELECT node_id, LAG(ts) OVER (PARTITION BY node_id ORDER BY ts, msg_offset) AS gap_start, ts AS gap_end,
         epoch_us(ts) - epoch_us(LAG(ts) OVER (PARTITION BY node_id ORDER BY ts, msg_offset)) AS gap_us
  FROM telemetry) WHERE gap_start IS NOT NULL AND gap_us > 5400000000""", "W2")
def gap_detection(spark, sf):
    return V.gaps(T.telemetry(spark, sf), "node_id", "ts", ["msg_offset"], nominal_seconds=3600, factor=1.5)


@register("gap_fill_linear", with_views("telemetry", extra=HN + f""",
p AS (SELECT node_id, hour, mw, LAG(hour) OVER w AS ph, LAG(mw) OVER w AS pm FROM hn
      WINDOW w AS (PARTITION BY node_id ORDER BY hour)),
g AS (SELECT node_id, ph, pm, mw, CAST((epoch_us(hour) - epoch_us(ph)) / 3600000000 AS BIGINT) - 1 AS k
      FROM p WHERE ph IS NOT NULL),
f AS (SELECT node_id, ph + to_hours(i) AS hour,
             CASE WHEN k <= 6 THEN {sround('pm + (mw - pm) * i / (k + 1)', 4)} END AS mw
      FROM g, unnest(generate_series(1, k)) AS t(i) WHERE k >= 1)""") + """
SELECT node_id, hour, mw, false AS is_filled FROM hn
UNION ALL
SELECT node_id, hour, mw, mw IS NOT NULL AS is_filled FROM f""", "W3")
def gap_fill_linear(spark, sf):
    return V.fill_linear(hourly(spark, sf), "node_id", "hour", "mw", step_hours=1, max_fill=6)


@register("outlier_zscore", with_views("telemetry", extra=HN + """,
s AS (SELECT node_id, hour, mw,
             COUNT(mw) OVER w AS n,
             CAST(SUM(CAST(mw AS DECIMAL(18,4))) OVER w AS DOUBLE) AS s1,
             CAST(SUM(CAST(mw AS DECIMAL(18,4)) * CAST(mw AS DECIMAL(18,4))) OVER w AS DOUBLE) AS s2
      FROM hn
      WINDOW w AS (PARTITION BY node_id ORDER BY CAST(epoch(hour) AS BIGINT)
                   RANGE BETWEEN 86400 PRECEDING AND 3600 PRECEDING)),
v AS (SELECT *, CASE WHEN n >= 2 THEN (s2 - s1 * s1 / n) / (n - 1) END AS var FROM s),
d AS (SELECT *, CASE WHEN var > 0 THEN sqrt(var) ELSE 0.0::DOUBLE END AS sd FROM v),
z AS (SELECT node_id, hour, mw, n,
             """ + sround("CASE WHEN n >= 12 AND sd > 0 THEN (mw - s1 / n) / sd END", 4) + """ AS z FROM d)""") + f"""
SELECT *, COALESCE(abs(z) > {num(3.0)}, false) AS is_outlier FROM z""", "W4")
def outlier_zscore(spark, sf):
    return V.zscore_outliers(hourly(spark, sf), "node_id", "hour", "mw")


@register("outlier_iqr", with_views("telemetry", extra=f"""
q AS (SELECT node_id, COUNT(mw) AS n, quantile_disc(mw, 0.25) AS q1, quantile_disc(mw, 0.75) AS q3
      FROM telemetry GROUP BY 1),
f AS (SELECT *, q3 - q1 AS iqr0, {sround(f'q1 - {num(1.5)} * (q3 - q1)', 4)} AS lo_fence,
             {sround(f'q3 + {num(1.5)} * (q3 - q1)', 4)} AS hi_fence FROM q),
o AS (SELECT t.node_id, COUNT_IF(mw < lo_fence OR mw > hi_fence) AS n_outliers
      FROM telemetry t JOIN f ON t.node_id = f.node_id GROUP BY 1)""") + f"""
SELECT f.node_id, n, q1, q3, {sround('iqr0', 4)} AS iqr, lo_fence, hi_fence, n_outliers
FROM f JOIN o ON f.node_id = o.node_id""", "W4")
def outlier_iqr(spark, sf):
    return V.iqr_outliers(T.telemetry(spark, sf), "node_id", "mw")


def asset_snapshots(spark, sf):
    """Three registry snapshots derived from ``part``: the second raises the list price of large
    assets by 10 %, the third renames the make of small ones; unchanged rows repeat."""
    a = T.assets(spark, sf).select("asset_id", "make", "list_price", "size_class")
    s1 = a.select("asset_id", "make", "list_price", F.lit(SNAPSHOTS[0]).cast("timestamp_ntz").alias("snapshot_ts"))
    p2 = F.when(F.col("size_class") > 40, dround(F.col("list_price") * F.lit(1.1), 2)).otherwise(F.col("list_price"))
    s2 = a.select("asset_id", "make", p2.alias("list_price"), F.lit(SNAPSHOTS[1]).cast("timestamp_ntz").alias("snapshot_ts"))
    m3 = F.when(F.col("size_class") < 5, F.concat(F.col("make"), F.lit("-R"))).otherwise(F.col("make"))
    s3 = a.select("asset_id", m3.alias("make"), p2.alias("list_price"),
                  F.lit(SNAPSHOTS[2]).cast("timestamp_ntz").alias("snapshot_ts"))
    return s1.unionByName(s2).unionByName(s3)


SNAP_SQL = f"""snap AS (
  SELECT asset_id, make, list_price, TIMESTAMP '{SNAPSHOTS[0]}' AS snapshot_ts FROM assets
  UNION ALL
  SELECT asset_id, make, CASE WHEN size_class > 40 THEN {sround(f'list_price * {num(1.1)}', 2)} ELSE list_price END,
         TIMESTAMP '{SNAPSHOTS[1]}' FROM assets
  UNION ALL
  SELECT asset_id, CASE WHEN size_class < 5 THEN make || '-R' ELSE make END,
         CASE WHEN size_class > 40 THEN {sround(f'list_price * {num(1.1)}', 2)} ELSE list_price END,
         TIMESTAMP '{SNAPSHOTS[2]}' FROM assets),
chg AS (SELECT *, (LAG(snapshot_ts) OVER w IS NULL OR make IS DISTINCT FROM LAG(make) OVER w
                   OR list_price IS DISTINCT FROM LAG(list_price) OVER w) AS c
        FROM snap WINDOW w AS (PARTITION BY asset_id ORDER BY snapshot_ts)),
ver AS (SELECT asset_id, make, list_price, snapshot_ts AS valid_from,
               LEAD(snapshot_ts) OVER (PARTITION BY asset_id ORDER BY snapshot_ts) AS valid_to,
               CAST(row_number() OVER (PARTITION BY asset_id ORDER BY snapshot_ts) AS INTEGER) AS version
        FROM chg WHERE c)"""


def asset_versions(spark, sf):
    return V.scd2(asset_snapshots(spark, sf), "asset_id", "snapshot_ts", ["make", "list_price"])


@register("scd2_history", with_views("assets", extra=SNAP_SQL) + """
SELECT asset_id, make, list_price, valid_from, valid_to, valid_to IS NULL AS is_current, version FROM ver""",
          "W5 D2")
def scd2_history(spark, sf):
    return asset_versions(spark, sf)


@register("point_in_time_plant", with_views("generation", "assets", extra=SNAP_SQL) + """
SELECT gen_order, gen_line, g.asset_id, ts, make, list_price
FROM generation g LEFT JOIN ver v ON g.asset_id = v.asset_id AND g.ts >= v.valid_from
     AND (v.valid_to IS NULL OR g.ts < v.valid_to)""", "J5")
def point_in_time_plant(spark, sf):
    facts = T.generation(spark, sf).select("gen_order", "gen_line", "asset_id", "ts")
    v = asset_versions(spark, sf).select("asset_id", "make", "list_price", "valid_from", "valid_to")
    return V.point_in_time(facts, v, "asset_id", "ts").select(
        "gen_order", "gen_line", "asset_id", "ts", "make", "list_price")


@register("flatline_runs", with_views("generation") + """
SELECT plant_id, mwh, run_start, run_end, run_length FROM (
  SELECT plant_id, run, first(mwh) AS mwh, MIN(ts) AS run_start, MAX(ts) AS run_end, COUNT(*) AS run_length
  FROM (SELECT *, SUM(s) OVER (PARTITION BY plant_id ORDER BY ts, gen_order, gen_line
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
        FROM (SELECT plant_id, ts, gen_order, gen_line, mwh,
                     CASE WHEN LAG(ts) OVER w IS NULL OR mwh IS DISTINCT FROM LAG(mwh) OVER w THEN 1 ELSE 0 END AS s
              FROM generation WINDOW w AS (PARTITION BY plant_id ORDER BY ts, gen_order, gen_line)))
  GROUP BY plant_id, run) WHERE run_length >= 2 AND mwh <> 0""", "W8")
def flatline_runs(spark, sf):
    """Stuck readings of a plant; the random readings here repeat twice at most, so runs of two count."""
    g = T.generation(spark, sf)
    return V.flatline_runs(g, "plant_id", ["ts", "gen_order", "gen_line"], "mwh", 2, nonzero=True)


@register("energy_integral", with_views("telemetry", extra="""
n AS (SELECT node_id, ts, mw, LEAD(ts) OVER w AS nts, LEAD(mw) OVER w AS nmw
      FROM telemetry WINDOW w AS (PARTITION BY node_id ORDER BY ts, msg_offset)),
i AS (SELECT node_id, CAST(ts AS DATE) AS day,
             CAST((mw + nmw) / 2.0::DOUBLE * ((epoch_us(nts) - epoch_us(ts)) / 3.6e9::DOUBLE) AS DECIMAL(38,9)) AS e
      FROM n WHERE nts IS NOT NULL AND epoch_us(nts) - epoch_us(ts) <= 7200000000)""") + f"""
SELECT node_id, day, {sround('CAST(SUM(e) AS DOUBLE)', 4)} AS mwh, COUNT(*) AS n_intervals FROM i GROUP BY 1, 2""",
          "A16")
def energy_integral(spark, sf):
    return V.energy_integral(T.telemetry(spark, sf), "node_id", "ts", ["msg_offset"], "mw", 7200)


def _weather_and_scada(spark, sf):
    t = T.telemetry(spark, sf)
    obs = t.filter(F.col("source_type") == "view").select(
        "node_id", F.col("ts").alias("obs_ts"), F.col("mw").alias("obs_mw"))
    scada = t.filter(F.col("source_type") != "view").select("msg_offset", "node_id", "ts", "mw")
    return scada, obs


@register("asof_weather", with_views("telemetry", extra="""
obs AS (SELECT node_id, ts AS obs_ts, mw AS obs_mw FROM telemetry WHERE source_type = 'view'),
scada AS (SELECT msg_offset, node_id, ts, mw FROM telemetry WHERE source_type <> 'view'),
j AS (SELECT s.*, o.obs_ts, o.obs_mw FROM scada s ASOF LEFT JOIN obs o
      ON s.node_id = o.node_id AND s.ts >= o.obs_ts)""") + """
SELECT msg_offset, node_id, ts, mw,
       CASE WHEN epoch_us(ts) - epoch_us(obs_ts) <= 7200000000 THEN obs_ts END AS obs_ts,
       CASE WHEN epoch_us(ts) - epoch_us(obs_ts) <= 7200000000 THEN obs_mw END AS obs_mw
FROM j""", "J4 J3")
def asof_weather(spark, sf):
    scada, obs = _weather_and_scada(spark, sf)
    return V.asof_join(scada, obs, "node_id", "ts", "obs_ts", ["obs_mw"], tolerance_seconds=7200)


_CAL_SQL = HN + """,
r AS (SELECT node_id, MIN(hour) AS lo, MAX(hour) AS hi FROM hn GROUP BY 1),
cal AS (SELECT node_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour FROM r)"""


@register("calendar_gaps", with_views("telemetry", extra=_CAL_SQL) + """
SELECT node_id, hour FROM cal WHERE NOT EXISTS (SELECT 1 FROM hn WHERE hn.node_id = cal.node_id AND hn.hour = cal.hour)""",
          "J9 T9")
def calendar_gaps(spark, sf):
    return V.calendar_gaps(hourly(spark, sf), "node_id", "hour")


@register("fallback_fill", with_views("telemetry", extra=_CAL_SQL + f""",
m AS (SELECT node_id, hour(hour) AS hod, {xs('mw', 4)} / COUNT(mw) AS m FROM hn GROUP BY 1, 2)""") + f"""
SELECT cal.node_id, cal.hour, COALESCE(hn.mw, {sround('m.m', 4)}) AS mw, (hn.mw IS NULL AND m.m IS NOT NULL) AS is_imputed
FROM cal LEFT JOIN hn ON cal.node_id = hn.node_id AND cal.hour = hn.hour
LEFT JOIN m ON cal.node_id = m.node_id AND hour(cal.hour) = m.hod""", "W9")
def fallback_fill(spark, sf):
    return V.fallback_fill(hourly(spark, sf), "node_id", "hour", "mw")
