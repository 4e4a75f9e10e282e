"""Layout queries (S14-S16, S18, S19): data written with a layout and read back through it."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattline.functions.columns import exact_sum
from wattline.operators import decode as DC
from wattline.operators import joins as J
from wattline.operators import ops as O
from wattline.plans import bronze_plans as BP
from wattline.plans import gold_plans
from wattline.plans.registry import ORACLE, register
from wattline.plans.sqlparts import xs
from wattline.plans.views import with_views
from wattline.session import scratch_path
from wattline.sources import bronze as B
from wattline.sources import compaction as P
from wattline.sources import messages as M
from wattline.sources import refresh as R
from wattline.sources import tables as T

DAY_FROM, DAY_TO = "2024-01-10", "2024-01-12"
# Years that each feed is kept before the date.
RETAIN_AS_OF, RETAIN_YEARS = "2002-06-30", {"scada": 7, "weather": 3, "trading": 10}


@register("partitioned_layout", with_views("telemetry") + f"""
SELECT CAST(ts AS DATE) AS event_date, node_id, COUNT(*) AS n, {xs('mw', 4)} AS mw_sum FROM telemetry
WHERE CAST(ts AS DATE) BETWEEN DATE '{DAY_FROM}' AND DATE '{DAY_TO}' AND node_id < 50 GROUP BY 1, 2""", "S14")
def partitioned_layout(spark, sf):
    """Day partitions plus node clustering: the date predicate prunes directories, the node
    predicate skips row groups by their min/max statistics."""
    path = scratch_path(spark, "telemetry_by_day")
    t = T.telemetry(spark, sf).withColumn("event_date", F.to_date("ts")).withColumnRenamed("ts", "timestamp")
    B.append_table(t, path, "telemetry")
    r = B.read_table(spark, path, "telemetry")
    r = r.filter(F.col("event_date").between(F.lit(DAY_FROM).cast("date"), F.lit(DAY_TO).cast("date"))
                 & (F.col("node_id") < 50))
    return r.groupBy("event_date", "node_id").agg(F.count(F.lit(1)).alias("n"), exact_sum("mw", 4, "mw_sum"))


def _telemetry_by_day(spark, sf):
    """Telemetry stored by day, with the calendar of its days beside it."""
    def build(path):
        t = T.telemetry(spark, sf).withColumn("event_date", F.to_date("ts")).withColumnRenamed("ts", "timestamp")
        B.append_table(t, path, "telemetry")
        O.calendar_dim(F.min("ts"), F.max("ts"), T.scan(spark, sf, "events"), southern=True).select("day", "is_weekend").distinct().coalesce(1).write.mode(
            "overwrite").parquet(f"{path}/calendar")
        spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{path}/end")
    return T.derived(spark, f"{sf.rstrip('/')}/events.parquet", "by-day", build, end="end/_SUCCESS")


@register("weekend_nodes", with_views("telemetry", extra=f"""
nd AS (SELECT n_nationkey AS nation, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey)""") + f"""
SELECT CAST(ts AS DATE) AS event_date, region, COUNT(*) AS n, {xs('mw', 4)} AS mw
FROM telemetry JOIN nd ON node_id % 25 = nation WHERE dayofweek(ts) IN (0, 6) AND region IN ('ASIA', 'EUROPE') GROUP BY 1, 2""", "J6 S14 F1")
def weekend_nodes(spark, sf):
    """Facts stored by day, filtered through two dimensions: the calendar's filter prunes the directories that the scan
    opens (dynamic partition pruning), that of the regions reaches the scan as a run-time filter on the node where the
    fact is large."""
    root = _telemetry_by_day(spark, sf)
    nodes = T.nodes(spark, sf).filter(F.col("region").isin("ASIA", "EUROPE")).select(F.col("node_id").alias("_nation"), "region")
    facts = J.through_days(B.read_table(spark, root, "telemetry"), spark.read.parquet(f"{root}/calendar").filter("is_weekend"), "event_date", "day")
    return (facts.join(nodes, F.col("node_id") % 25 == F.col("_nation")).groupBy("event_date", "region")
            .agg(F.count(F.lit(1)).alias("n"), exact_sum("mw", 4, "mw")))


@register("clustered_layout", with_views("generation") + f"""
SELECT plant_id, COUNT(*) AS n, {xs('mwh', 2)} AS mwh FROM generation WHERE plant_id BETWEEN 10 AND 19 GROUP BY 1""",
          "S15")
def clustered_layout(spark, sf):
    """Range-clustered files on (plant, time): a plant-range predicate reads only the files and
    row groups whose min/max cover it."""
    path = scratch_path(spark, "generation_clustered")
    size = sum(f[1] for f in T.files_of(spark, f"{sf.rstrip('/')}/lineitem.parquet"))
    B.clustered_write(T.generation(spark, sf), path, ["plant_id", "ts"], size)
    r = spark.read.parquet(path).filter(F.col("plant_id").between(10, 19))
    return r.groupBy("plant_id").agg(F.count(F.lit(1)).alias("n"), exact_sum("mwh", 2, "mwh"))


#: Bytes of lineitem for each load.
LOAD_BYTES = 16 << 20


@register("compaction", with_views("generation") + f"""
SELECT CAST(year(ts) AS INTEGER) AS year, COUNT(*) AS n, {xs('mwh', 2)} AS mwh FROM generation GROUP BY 1""", "S16")
def compaction(spark, sf):
    """The small files that four loads (more for large tables: each is written by one task, a file per year) have
    written are packed into files of the target size (one per year at this scale), in place; full-sized files
    stay; the content is unchanged."""
    path = scratch_path(spark, "small_files")
    g = T.generation(spark, sf).withColumn("year", F.year("ts"))
    size = sum(f[1] for f in T.files_of(spark, f"{sf.rstrip('/')}/lineitem.parquet"))
    g.repartition(max(4, -(-size // LOAD_BYTES)), "gen_order").write.mode("overwrite").partitionBy("year").parquet(path)
    P.compact(spark, path, order=["plant_id", "ts"])
    r = spark.read.parquet(path)
    return r.groupBy("year").agg(F.count(F.lit(1)).alias("n"), exact_sum("mwh", 2, "mwh"))


@register("retention_filter", with_views("generation") + " UNION ALL ".join(f"""
SELECT '{feed}' AS feed, CAST(year(ts) AS INTEGER) AS year, COUNT(*) AS n FROM generation
WHERE CAST(ts AS DATE) >= DATE '{RETAIN_AS_OF}' - INTERVAL {12 * years} MONTH GROUP BY 1, 2""" for feed, years in RETAIN_YEARS.items()), "S18")
def retention_filter(spark, sf):
    """Retention on stored tables partitioned by year: expired partitions go, the partition that holds
    the limit is rewritten, the others stay as they are."""
    out = None
    for feed, years in RETAIN_YEARS.items():
        path = scratch_path(spark, f"retention_{feed}")
        T.generation(spark, sf).withColumn("year", F.year("ts")).write.partitionBy("year").parquet(path)
        B.retain(spark, path, "year", "ts", RETAIN_AS_OF, 12 * years)
        r = spark.read.parquet(path).groupBy("year").agg(F.count(F.lit(1)).alias("n")).select(F.lit(feed).alias("feed"), "year", "n")
        out = r if out is None else out.unionByName(r)
    return out


@register("gold_materialize", ORACLE["fact_revenue_region_month"], "S19")
def gold_materialize(spark, sf):
    """The fact table is stored partitioned by region.  A stale copy is written first (one
    region wrong), then only that region is recomputed and written with dynamic partition
    overwrite: the other regions' files are left as they were, and the result is correct."""
    path = scratch_path(spark, "fact_revenue")
    fact = gold_plans.fact_revenue_region_month(spark, sf)
    stale = fact.withColumn("revenue", F.when(F.col("region") == "ASIA", F.col("revenue") * 2).otherwise(F.col("revenue")))
    B.materialize(stale, path, ["region"])
    B.materialize(fact.filter(F.col("region") == "ASIA"), path, ["region"])
    return spark.read.parquet(path).select(*fact.columns)


RETAIN_DAYS_AS_OF = "2024-02-12"


@register("retention_days", with_views("telemetry") + f"""
SELECT CAST(ts AS DATE) AS event_date, COUNT(*) AS n FROM telemetry
WHERE CAST(ts AS DATE) >= DATE '{RETAIN_DAYS_AS_OF}' - INTERVAL 1 MONTH GROUP BY 1""", "S18")
def retention_days(spark, sf):
    """Retention on the Bronze layout (a directory for each day): directories before the limit go, no file is rewritten."""
    root = scratch_path(spark, "retention_days")
    t = T.telemetry(spark, sf).withColumn("event_date", F.to_date("ts")).withColumnRenamed("ts", "timestamp")
    path = B.append_table(t, root, "telemetry")
    B.retain(spark, path, "event_date", "timestamp", RETAIN_DAYS_AS_OF, 1)
    return spark.read.parquet(path).groupBy("event_date").agg(F.count(F.lit(1)).alias("n"))


LATE_TENS = 3       # fixed rule of the binding: messages with props.k from 30 to 39 come in a later load


def node_region(spark, sf):
    """A telemetry node lies in the nation (of 25, checked by the broadcast's size bound) that its number falls on."""
    where = T.nodes(spark, sf).select(F.col("node_id").alias("_nation"), "region")

    def add(rows):
        nation = F.substring("node_id", 2, 20).try_cast("long") % 25
        return rows.join(F.broadcast(where), nation == F.col("_nation"), "left").drop("_nation")
    return add


@register("gold_refresh", BP.MSG_SQL + f""",
nd AS (SELECT n_nationkey AS nation, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey),
g AS (SELECT region, 'N' || user_id AS node_id, CAST(ts AS DATE) AS event_date, mw
      FROM mm LEFT JOIN nd ON user_id % 25 = nation
      WHERE topic = 'energy.bronze.scada' AND error_message IS NULL AND k NOT IN {BP.ROW_REJECT})
SELECT 'day' AS level, region, event_date AS period, node_id, COUNT(*) AS n, {xs('mw', 4)} AS total FROM g GROUP BY 2, 3, 4
UNION ALL
SELECT 'month', region, CAST(date_trunc('month', event_date) AS DATE), NULL, COUNT(*), {xs('mw', 4)} FROM g GROUP BY 2, 3""", "S19 A17")
def gold_refresh(spark, sf):
    """Two loads, the second with late messages: each refresh rebuilds the (region, day) partitions that the new
    batches touch, and the months they lie in."""
    gold = gold_root(spark, sf)
    cols = ["region", F.col("period").cast("date").alias("period"), "node_id", "n", "total"]
    day = spark.read.parquet(f"{gold}/fact_day").withColumnRenamed("event_date", "period").select(F.lit("day").alias("level"), *cols)
    month = (spark.read.parquet(f"{gold}/fact_month").withColumnRenamed("month", "period")
             .withColumn("node_id", F.lit(None).cast("string")).select(F.lit("month").alias("level"), *cols))
    return day.unionByName(month)


def gold_root(spark, sf):
    """Gold folder that two loads and their refreshes have made."""
    def build(path):
        msgs = DC.decode_json(M.read_topics(spark, M.publish_topics(spark, sf), ["scada"]))
        late = F.coalesce(F.floor(M.payload_k(F.col("value")) / 10) == LATE_TENS, F.lit(False))
        for epoch, part in (("load-1", msgs.filter(~late)), ("load-2", msgs.filter(late))):
            B.land(part, f"{path}/bronze", epoch)
            R.refresh(spark, f"{path}/bronze", f"{path}/gold", node_region(spark, sf))
        spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{path}/end")
    return T.derived(spark, f"{sf.rstrip('/')}/events.parquet", "refresh", build, end="end/_SUCCESS") + "/gold"
