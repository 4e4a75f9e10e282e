"""Queries on stored sketches (A20, V3, V15, T8).  Each builds its table in two refreshes (the days of the first half
of the month, then the rest), reads spans from sketches only, and sets the estimates against exact figures:
what is returned is exact, with the verdict whether the estimate keeps its stated bound."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattline.operators import sketches as K
from wattline.plans.registry import register
from wattline.plans.views import with_views
from wattline.sources import tables as T

SPLIT = "2024-01-16"
RANKS = [0.05, 0.25, 0.5, 0.75, 0.95]


def _rows(spark, sf):
    t = T.telemetry(spark, sf).withColumn("day", F.to_date("ts"))
    # a reading's key: node and second
    return t.withColumn("reading", F.concat_ws(":", "node_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))


def _stored(spark, sf):
    def build(path):
        rows = _rows(spark, sf)
        for part in (rows.filter(F.col("day") < F.lit(SPLIT).cast("date")), rows):
            K.store(part, f"{path}/daily", "day", ["source_type"], {"node": F.col("node_id"), "reading": F.col("reading")}, {"mw": F.col("mw")})
        spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{path}/end")
    return spark.read.parquet(T.derived(spark, f"{sf.rstrip('/')}/events.parquet", "sketches", build, end="end/_SUCCESS") + "/daily")


@register("distinct_sketches", with_views("telemetry") + """
SELECT CAST(date_trunc('week', ts) AS DATE) AS week, source_type, COUNT(*) AS n, COUNT(DISTINCT node_id) AS nodes,
       COUNT(DISTINCT node_id || ':' || strftime(ts, '%Y-%m-%d %H:%M:%S')) AS readings, true AS within_bound
FROM telemetry GROUP BY 1, 2""", "A20 V3")
def distinct_sketches(spark, sf):
    """Distinct nodes and readings of each week and source, from the sketches of its days."""
    span = ["week", "source_type"]
    daily = _stored(spark, sf).withColumn("week", F.to_date(F.date_trunc("week", "day")))
    est = K.distinct_over(daily, span, "node").withColumnRenamed("n_distinct", "e_nodes").join(
        K.distinct_over(daily, span, "reading").select(*span, F.col("n_distinct").alias("e_readings")), span)
    exact = _rows(spark, sf).withColumn("week", F.to_date(F.date_trunc("week", "day"))).groupBy(*span).agg(
        F.count_distinct("node_id").alias("nodes"), F.count_distinct("reading").alias("readings"))
    near = [F.abs(F.col(f"e_{c}") - F.col(c)) <= F.ceil(F.col(c) * F.lit(K.DISTINCT_BOUND)) for c in ("nodes", "readings")]
    return est.join(exact, span).select(*span, "n", "nodes", "readings", (near[0] & near[1]).alias("within_bound"))


@register("quantile_sketches", with_views("telemetry") + """
SELECT CAST(date_trunc('month', ts) AS DATE) AS month, source_type, COUNT(mw) AS n_values, true AS within_bound
FROM telemetry GROUP BY 1, 2""", "V15 T8")
def quantile_sketches(spark, sf):
    """Quantiles of the readings of each month and source, merged from daily sketches."""
    span = ["month", "source_type"]
    found = K.quantiles_over(_stored(spark, sf).withColumn("month", F.to_date(F.date_trunc("month", "day"))), span, "mw", RANKS)
    rows = _rows(spark, sf).withColumn("month", F.to_date(F.date_trunc("month", "day")))
    errors = K.rank_errors(rows, span, F.col("mw"), found.select(*span, "q"), RANKS)
    near = F.forall("errors", lambda e: e <= K.RANK_BOUND) & (F.col("n_values") == F.col("n_sketch"))
    return errors.join(found.select(*span, F.col("n_values").alias("n_sketch")), span).select(*span, "n_values", near.alias("within_bound"))
