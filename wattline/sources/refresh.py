"""Change-driven refresh of Gold (S19, A17): the batches that Bronze has landed since the last refresh say which
(region, day) partitions of the facts are stale; these, and the months they lie in, are computed again from
Bronze and replaced by dynamic partition overwrite.  All other files stay as they are.

Under the Gold folder stand ``fact_day`` (region, day), ``fact_month`` (region, month), rolled up from
``fact_day``, and ``_refreshed``: the batches that are in.  A refresh that broke off is simply done again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.functions.columns import exact_sum
from wattline.session import materialized
from wattline.sources import bronze as B

DONE = "_refreshed"


def new_batches(spark: SparkSession, bronze: str, gold: str, table: str) -> list[str]:
    """Names of the batches of a Bronze table that no refresh has taken in, from listings only."""
    fs, at = B._fs(spark, f"{bronze}/{table}")
    if not fs.exists(at):
        return []
    landed = {f.getPath().getName().partition("=")[2] for f in fs.listStatus(at) if f.getPath().getName().startswith("batch=")}
    done = f"{gold}/{DONE}"
    known = {r.batch for r in spark.read.parquet(done).collect()} if B.exists(spark, done) else set()      # one row a batch
    return sorted(landed - known)


def refresh(spark: SparkSession, bronze: str, gold: str, region_of: Callable[[DataFrame], DataFrame],
            table: str = "scada_telemetry", value: str = "solar_mw", scale: int = 4) -> DataFrame | None:
    """Take the new batches in; returns the (region, event_date) partitions that were replaced, or None.

    ``region_of`` adds ``region`` to rows with ``node_id``.  Facts: rows and exact sum of ``value`` for each node
    and day, and for each region and month."""
    batches = new_batches(spark, bronze, gold, table)
    if not batches:
        return None
    rows = B.read_table(spark, bronze, table).withColumn("batch", F.col("batch").cast("string"))
    stale = materialized(region_of(rows.filter(F.col("batch").isin(batches)).select("node_id", "event_date"))
                         .select("region", "event_date").distinct(), "stale-partitions")
    days = [r.event_date for r in stale.select("event_date").distinct().collect()]        # a calendar at most
    if days:
        again = region_of(rows.filter(F.col("event_date").isin(days)).select("node_id", "event_date", value))
        facts = (again.join(stale, ["region", "event_date"], "left_semi").groupBy("region", "event_date", "node_id")
                 .agg(F.count(F.lit(1)).alias("n"), exact_sum(value, scale, "total")))
        B.materialize(facts.repartitionByRange("region", "event_date", "node_id"), f"{gold}/fact_day", ["region", "event_date"])
        months = stale.select("region", F.trunc("event_date", "month").alias("month")).distinct()
        spans = {(d.year, d.month) for d in days}
        day = spark.read.parquet(f"{gold}/fact_day")
        of_months = day.filter(F.struct(F.year("event_date"), F.month("event_date")).isin(
            *[F.struct(F.lit(y), F.lit(m)) for y, m in sorted(spans)])).withColumn("month", F.trunc("event_date", "month"))
        rolled = (of_months.join(months, ["region", "month"], "left_semi").groupBy("region", "month")
                  .agg(F.sum("n").alias("n"), F.count_distinct("node_id").alias("nodes"), exact_sum("total", scale, "total")))
        B.materialize(rolled.coalesce(1), f"{gold}/fact_month", ["region", "month"])
    spark.createDataFrame([(b,) for b in batches], "batch string").coalesce(1).write.mode("append").parquet(f"{gold}/{DONE}")
    return stale
