"""Stored sketches: bounds against exact figures, and old days aren't read or written again."""

import datetime as dt

from pyspark.sql import functions as F

from tests.test_dimensions import files
from wattline.operators import sketches as K
from wattline.session import scratch_path


def rows(spark, days):
    """60,000 rows; one group holds half of them; a key for every three rows, shared by days."""
    r = spark.range(60_000).withColumn("day", F.expr(f"date_add(DATE'2024-03-01', cast(id % {days} as int))"))
    return r.withColumns({"g": F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string"))),
                          "key": F.floor(F.col("id") / 3), "v": F.when(F.col("id") % 11 != 0, F.pow(F.col("id") % 9973, F.lit(2)))})


def test_spans_from_days(spark):
    path = scratch_path(spark, "t_sketch")
    df = rows(spark, 20)

    def store(part, **more):
        K.store(part, path, "day", ["g"], {"key": F.col("key")}, {"v": F.col("v")}, **more)
    store(df.filter("day < DATE'2024-03-11'"))
    before = files(path)
    store(df)
    after = files(path)
    assert {f: t for f, t in after.items() if f in before} == before and len(after) > len(before)
    stored = spark.read.parquet(path)
    for span in (["g"], ["g", "half"]):
        half = (F.col("day") < dt.date(2024, 3, 11)).alias("half")
        s, d = stored.select("*", half), df.select("*", half)
        exact = {tuple(r[c] for c in span): r for r in d.groupBy(*span).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("key").alias("k"),
                                                                          F.count("v").alias("v")).collect()}
        found = {tuple(r[c] for c in span): r for r in K.distinct_over(s, span, "key").collect()}
        assert set(found) == set(exact)
        for k, r in found.items():
            assert r.n == exact[k].n and abs(r.n_distinct - exact[k].k) <= K.DISTINCT_BOUND * exact[k].k
        q = K.quantiles_over(s, span, "v", [0.01, 0.5, 0.99])
        for r in K.rank_errors(d, span, F.col("v"), q.select(*span, "q"), [0.01, 0.5, 0.99]).collect():
            assert r.n_values == exact[tuple(r[c] for c in span)].v and max(r.errors) <= K.RANK_BOUND


def test_late_days_and_empty(spark):
    path = scratch_path(spark, "t_sketch_late")
    df = rows(spark, 4)
    K.store(df.filter("id > 100"), path, "day", ["g"], {"key": F.col("key")}, {"v": F.col("v")})
    K.store(df, path, "day", ["g"], {"key": F.col("key")}, {"v": F.col("v")}, again=[dt.date(2024, 3, 1)])
    n = {r.day: r.n for r in spark.read.parquet(path).groupBy("day").agg(F.sum("n").alias("n")).collect()}
    assert n[dt.date(2024, 3, 1)] == 15_000 and n[dt.date(2024, 3, 2)] == 15_000 - 26 + 1
    K.store(df.limit(0), path, "day", ["g"], {"key": F.col("key")}, {"v": F.col("v")})
    nulls = scratch_path(spark, "t_sketch_null")
    K.store(df.limit(5).withColumn("v", F.lit(None).cast("double")), nulls, "day", ["g"], {"key": F.lit(None).cast("string")}, {"v": F.col("v")})
    stored = spark.read.parquet(nulls)
    assert K.distinct_over(stored, ["g"], "key").agg(F.max("n_distinct")).first()[0] == 0
    assert K.quantiles_over(stored, ["g"], "v", [0.5]).filter("q is not null").count() == 0
