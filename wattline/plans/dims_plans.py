"""Dimension queries (D1-D4) bound to the driver's tables.  Surrogate keys are dense 1..n in
natural-key order, assigned without a single-partition window."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from wattline.functions.columns import dround
from wattline.operators import dimensions as D
from wattline.operators import ops as O
from wattline.operators import silver as V
from wattline.plans.derive_plans import _CLIMATE_SQL, _climate_col
from wattline.plans.registry import register
from wattline.plans.sqlparts import dround as sround
from wattline.plans.sqlparts import num
from wattline.plans.views import with_views
from wattline.session import scratch_path
from wattline.sources import tables as T


@register("dim_node", with_views("telemetry", "nodes") + f"""
SELECT CAST(row_number() OVER (ORDER BY t.node_id) AS BIGINT) AS node_key, t.node_id, region, climate, n_samples, n_sources FROM (
  SELECT node_id, {_CLIMATE_SQL} AS climate, COUNT(*) AS n_samples, COUNT(DISTINCT source_type) AS n_sources
  FROM telemetry GROUP BY 1) t LEFT JOIN nodes ON t.node_id % 25 = nodes.node_id""", "D1")
def dim_node(spark, sf):
    """A telemetry node lies in the nation (of 25) that its number falls on."""
    n = T.telemetry(spark, sf).groupBy("node_id").agg(F.count(F.lit(1)).alias("n_samples"),
                                                        F.count_distinct("source_type").alias("n_sources"))
    n = n.withColumn("climate", _climate_col(F.col("node_id")))
    where = T.nodes(spark, sf).select(F.col("node_id").alias("_nation"), "region")
    n = n.join(F.broadcast(where), F.col("node_id") % 25 == F.col("_nation"), "left")
    return O.with_surrogate(n, ["node_id"], "node_key").select("node_key", "node_id", "region", "climate", "n_samples", "n_sources")


# Plant snapshots derived from ``plants``: by the second, plants in debt have grown by a tenth; by the
# third, every seventh plant has moved its contract to the next node.
_SNAP = ["2024-01-01 00:00:00", "2024-06-01 00:00:00", "2025-01-01 00:00:00"]
_GROWN = sround(f"capacity_mw * {num(1.1)}", 2)
_PLANT_VERSIONS = f"""snap AS (
  SELECT plant_id, plant_name, region, node_id, capacity_mw, TIMESTAMP '{_SNAP[0]}' AS snapshot_ts FROM plants
  UNION ALL
  SELECT plant_id, plant_name, region, node_id, CASE WHEN acctbal < 0 THEN {_GROWN} ELSE capacity_mw END, TIMESTAMP '{_SNAP[1]}' FROM plants
  UNION ALL
  SELECT plant_id, plant_name, region, CAST(CASE WHEN plant_id % 7 = 0 THEN (node_id + 1) % 25 ELSE node_id END AS INTEGER),
         CASE WHEN acctbal < 0 THEN {_GROWN} ELSE capacity_mw END, TIMESTAMP '{_SNAP[2]}' FROM plants),
chg AS (SELECT *, LAG(snapshot_ts) OVER w IS NULL OR node_id IS DISTINCT FROM LAG(node_id) OVER w
                  OR capacity_mw IS DISTINCT FROM LAG(capacity_mw) OVER w AS c
        FROM snap WINDOW w AS (PARTITION BY plant_id ORDER BY snapshot_ts)),
v AS (SELECT plant_id, plant_name, region, node_id, capacity_mw, snapshot_ts AS valid_from,
             LEAD(snapshot_ts) OVER (PARTITION BY plant_id ORDER BY snapshot_ts) AS valid_to,
             CAST(row_number() OVER (PARTITION BY plant_id ORDER BY snapshot_ts) AS INTEGER) AS version FROM chg WHERE c)"""


@register("dim_plant", with_views("plants", extra=_PLANT_VERSIONS) + """
SELECT CAST(row_number() OVER (ORDER BY plant_id, version) AS BIGINT) AS plant_key, plant_id, plant_name, node_id, region,
       capacity_mw, valid_from, valid_to, valid_to IS NULL AS is_current, version FROM v""", "D2 W5")
def dim_plant(spark, sf):
    """SCD2: a key per version, in order of plant and version."""
    p = T.plants(spark, sf).select("plant_id", "plant_name", "region", "node_id", "capacity_mw", "acctbal")
    grown = F.when(F.col("acctbal") < 0, dround(F.col("capacity_mw") * F.lit(1.1), 2)).otherwise(F.col("capacity_mw"))
    moved = F.when(F.col("plant_id") % 7 == 0, (F.col("node_id") + 1) % 25).otherwise(F.col("node_id")).cast("int")
    at = [F.lit(x).cast("timestamp_ntz").alias("snapshot_ts") for x in _SNAP]
    same = ["plant_id", "plant_name", "region"]
    snaps = (p.select(*same, "node_id", "capacity_mw", at[0])
             .unionByName(p.select(*same, "node_id", grown.alias("capacity_mw"), at[1]))
             .unionByName(p.select(*same, moved.alias("node_id"), grown.alias("capacity_mw"), at[2])))
    versions = V.scd2(snaps, "plant_id", "snapshot_ts", ["node_id", "capacity_mw"])
    return O.with_surrogate(versions, ["plant_id", "version"], "plant_key").select(
        "plant_key", "plant_id", "plant_name", "node_id", "region", "capacity_mw", "valid_from", "valid_to", "is_current", "version")


@register("dim_time", """
WITH b AS (SELECT date_trunc('hour', MIN(ts)) AS lo, date_trunc('hour', MAX(ts)) AS hi FROM events),
h AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour FROM b)
SELECT CAST(hour AS TIMESTAMP) AS hour, CAST(hour AS DATE) AS day, CAST(date_trunc('month', hour) AS DATE) AS month,
       CAST(hour(hour) AS INTEGER) AS hour_of_day, dayofweek(hour) IN (0, 6) AS is_weekend,
       CASE WHEN month(hour) IN (12, 1, 2) THEN 'summer' WHEN month(hour) IN (6, 7, 8) THEN 'winter'
            WHEN month(hour) IN (3, 4, 5) THEN 'autumn' ELSE 'spring' END AS season
FROM h""", "D3")
def dim_time(spark, sf):
    e = T.scan(spark, sf, "events")
    return O.calendar_dim(F.min("ts"), F.max("ts"), e, southern=True)


@register("dim_asset", with_views("assets") + """
SELECT CAST(row_number() OVER (ORDER BY asset_id) AS BIGINT) AS asset_key, asset_id, asset_name, make, model
FROM assets""", "D4")
def dim_asset(spark, sf):
    a = T.assets(spark, sf).select("asset_id", "asset_name", "make", "model")
    return O.with_surrogate(a, ["asset_id"], "asset_key").select("asset_key", "asset_id", "asset_name", "make", "model")


@register("dim_weather_station", with_views("telemetry") + """
SELECT CAST(row_number() OVER (ORDER BY station_id) AS BIGINT) AS station_key, * FROM (
  SELECT 'WS-' || node_id AS station_id, node_id, COUNT(*) AS n_observations, MIN(ts) AS first_seen,
         MAX(ts) AS last_seen FROM telemetry WHERE source_type = 'view' GROUP BY 1, 2)""", "D4")
def dim_weather_station(spark, sf):
    t = T.telemetry(spark, sf).filter(F.col("source_type") == "view")
    s = t.groupBy(F.concat(F.lit("WS-"), F.col("node_id").cast("string")).alias("station_id"), "node_id").agg(
        F.count(F.lit(1)).alias("n_observations"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"))
    return O.with_surrogate(s, ["station_id"], "station_key").select(
        "station_key", "station_id", "node_id", "n_observations", "first_seen", "last_seen")


# Loads of the incremental dimension: the first snapshot, the third, then the second, which comes late.  In
# the third, every eleventh plant is back at its first capacity.
_LOADS = [_SNAP[0], _SNAP[2], _SNAP[1]]
_INCREMENTAL = f"""s1 AS (SELECT plant_id, node_id, capacity_mw, TIMESTAMP '{_SNAP[0]}' AS "at" FROM plants),
s2 AS (SELECT plant_id, node_id, CASE WHEN acctbal < 0 THEN {_GROWN} ELSE capacity_mw END AS capacity_mw, TIMESTAMP '{_SNAP[1]}' AS "at" FROM plants),
s3 AS (SELECT plant_id, CAST(CASE WHEN plant_id % 7 = 0 THEN (node_id + 1) % 25 ELSE node_id END AS INTEGER) AS node_id,
              CASE WHEN acctbal < 0 AND plant_id % 11 <> 0 THEN {_GROWN} ELSE capacity_mw END AS capacity_mw, TIMESTAMP '{_SNAP[2]}' AS "at" FROM plants),
snap AS (SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM s3),
chg AS (SELECT *, LAG("at") OVER w IS NULL OR node_id IS DISTINCT FROM LAG(node_id) OVER w
                  OR capacity_mw IS DISTINCT FROM LAG(capacity_mw) OVER w AS c
        FROM snap WINDOW w AS (PARTITION BY plant_id ORDER BY "at")),
v AS (SELECT plant_id, node_id, capacity_mw, "at" AS valid_from, LEAD("at") OVER (PARTITION BY plant_id ORDER BY "at") AS valid_to,
             CAST(row_number() OVER (PARTITION BY plant_id ORDER BY "at") AS INTEGER) AS version FROM chg WHERE c),
k1 AS (SELECT plant_id, "at" AS valid_from, row_number() OVER (ORDER BY plant_id) AS k FROM s1),
k2 AS (SELECT s3.plant_id, s3."at" AS valid_from, (SELECT COUNT(*) FROM k1) + row_number() OVER (ORDER BY s3.plant_id) AS k
       FROM s3 JOIN s1 ON s1.plant_id = s3.plant_id
       WHERE s1.node_id IS DISTINCT FROM s3.node_id OR s1.capacity_mw IS DISTINCT FROM s3.capacity_mw),
k12 AS (SELECT * FROM k1 UNION ALL SELECT * FROM k2),
k3 AS (SELECT v.plant_id, v.valid_from, (SELECT COUNT(*) FROM k12) + row_number() OVER (ORDER BY v.plant_id, v.valid_from) AS k
       FROM v LEFT JOIN k12 ON k12.plant_id = v.plant_id AND k12.valid_from = v.valid_from WHERE k12.k IS NULL),
k AS (SELECT * FROM k12 UNION ALL SELECT * FROM k3)"""


@register("dim_plant_incremental", with_views("plants", extra=_INCREMENTAL) + """
SELECT CAST(k AS BIGINT) AS plant_key, v.plant_id, node_id, capacity_mw, v.valid_from, valid_to, valid_to IS NULL AS is_current, version
FROM v JOIN k ON k.plant_id = v.plant_id AND k.valid_from = v.valid_from""", "D2 W5 P15")
def dim_plant_incremental(spark, sf):
    """SCD2 kept by merging one snapshot after the other, the second one late: it splits the versions that
    it falls into.  Keys given out by an earlier load stay; new versions go on from the largest."""
    p = T.plants(spark, sf).select("plant_id", "node_id", "capacity_mw", "acctbal")
    grown = dround(F.col("capacity_mw") * F.lit(1.1), 2)
    debt = F.col("acctbal") < 0
    moved = F.when(F.col("plant_id") % 7 == 0, (F.col("node_id") + 1) % 25).otherwise(F.col("node_id")).cast("int")
    snaps = {_SNAP[0]: p.select("plant_id", "node_id", "capacity_mw"),
             _SNAP[1]: p.select("plant_id", "node_id", F.when(debt, grown).otherwise(F.col("capacity_mw")).alias("capacity_mw")),
             _SNAP[2]: p.select("plant_id", moved.alias("node_id"),
                                F.when(debt & (F.col("plant_id") % 11 != 0), grown).otherwise(F.col("capacity_mw")).alias("capacity_mw"))}

    def build(path):
        for at in _LOADS:
            D.load_snapshot(spark, path, snaps[at], "plant_id", ["node_id", "capacity_mw"], dt.datetime.fromisoformat(at), "plant_key")
        spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{path}/end")
    path = T.derived(spark, f"{sf.rstrip('/')}/supplier.parquet", "dim-plant", build, end="end/_SUCCESS")
    return D.versions(spark, path).select("plant_key", "plant_id", "node_id", "capacity_mw", "valid_from", "valid_to", "is_current", "version")


@register("dim_asset_incremental", with_views("assets") + """
SELECT CAST(CASE WHEN asset_id % 2 = 0 THEN row_number() OVER (PARTITION BY asset_id % 2 ORDER BY asset_id)
            ELSE (SELECT COUNT(*) FROM assets WHERE asset_id % 2 = 0) + row_number() OVER (PARTITION BY asset_id % 2 ORDER BY asset_id) END AS BIGINT)
         AS asset_key, asset_id, asset_name, make, model FROM assets""", "D4 P15")
def dim_asset_incremental(spark, sf):
    """Two deliveries of the registry: even asset ids first, then all.  Keys of the first one stay."""
    a = T.assets(spark, sf).select("asset_id", "asset_name", "make", "model")
    path = scratch_path(spark, "dim-asset")
    D.stable_keys(spark, path, a.filter("asset_id % 2 = 0"), ["asset_id"], "asset_key")
    return D.stable_keys(spark, path, a, ["asset_id"], "asset_key").select("asset_key", "asset_id", "asset_name", "make", "model")
