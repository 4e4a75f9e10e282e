"""Run-time pruning: the scan opens matching directories only, and run-time filters reach the fact."""

import os

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.test_dimensions import files
from wattline.operators import joins as J
from wattline.plans import layout_plans
from wattline.session import scratch_path
from wattline.sources import bronze as B


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_matching_directories_are_opened(spark):
    path = scratch_path(spark, "t_prune")
    (spark.range(400).select("id", F.expr("date_add(DATE'2024-01-01', CAST(id % 20 AS INT))").alias("event_date"))
     .repartition(2).write.partitionBy("event_date").parquet(path))
    days = scratch_path(spark, "t_prune_days")
    (spark.range(20).select(F.expr("date_add(DATE'2024-01-01', CAST(id AS INT))").alias("day"), (F.col("id") % 5 == 0).alias("chosen"))
     .write.parquet(days))
    for f in files(path):
        if int(f.split("event_date=2024-01-")[1][:2]) % 5 != 1:           # a file that is read by mistake fails the query
            with open(f, "wb") as out:
                out.write(b"broken")
            crc = f"{os.path.dirname(f)}/.{os.path.basename(f)}.crc"
            if os.path.exists(crc):
                os.remove(crc)
    schema = "id long, event_date date"
    out = J.through_days(spark.read.schema(schema).parquet(path), spark.read.parquet(days).filter("chosen"), "event_date", "day")
    assert "dynamicpruning#" in plan(out)
    assert out.count() == 80


def test_query_plan_has_the_subquery_filter(spark):
    out = layout_plans.weekend_nodes(spark, SF_SMALL)
    assert "dynamicpruning#" in plan(out)
    assert "is_weekend" in plan(out)
    none = J.through_days(spark.range(3).selectExpr("DATE'2024-01-01' AS d"), spark.range(0).selectExpr("DATE'2024-01-01' AS day"), "d", "day")
    assert none.count() == 0


def test_run_time_bloom_filter_on_a_large_fact(spark):
    """Where the dimension can't be broadcast, its keys reach the fact's scan as a bloom filter."""
    fact, dim = scratch_path(spark, "t_bloom_f"), scratch_path(spark, "t_bloom_d")
    spark.range(20_000).select((F.col("id") % 5000).alias("plant"), F.col("id").alias("v")).write.parquet(fact)
    spark.range(5000).select(F.col("id").alias("plant"), (F.col("id") % 100).alias("kind")).write.parquet(dim)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        out = spark.read.parquet(fact).join(spark.read.parquet(dim).filter("kind = 3"), "plant")
        assert "might_contain" in plan(out) and out.count() == 200
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_broadcast_is_bounded_by_bytes(spark):
    narrow = spark.range(1000)
    wide = narrow.withColumn("x", F.expr("repeat('x', 1000)"))
    assert "broadcast" in J.broadcast_if_small(narrow, 1000, 1 << 20)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in J.broadcast_if_small(wide, 1000, 1 << 19)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in J.broadcast_if_small(narrow, 999)._jdf.queryExecution().logical().toString().lower()
    assert B.read_seed_csv(spark, scratch_path(spark, "none"), ["a"]).count() == 0
