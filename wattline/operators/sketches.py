"""Stored sketches (A20, V3, V15, T8): distinct counts and quantiles over any span without reading its rows again.

For every day (and group) one row is kept with a HyperLogLog sketch for each key column and a KLL sketch for
each value column.  Sketches are built by an aggregate, combined in each task first, so a hot group sends one
sketch a task; sketches of days merge into those of weeks or months.  The table is partitioned by day, and only
days that are not stored yet are scanned.

Bounds, stated for the settings here: a distinct count is off by at most 3 x 1.04 / sqrt(2^14) = 2.4 %, a
quantile by 1 % of the rows in rank.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.sources.bronze import exists

LG_K = 14
KLL_K = 800
DISTINCT_BOUND = 3 * 1.04 / 2 ** (LG_K / 2)
RANK_BOUND = 0.01


def stored_days(spark: SparkSession, path: str, day: str = "day") -> DataFrame | None:
    return spark.read.parquet(path).select(day).distinct() if exists(spark, path) else None


def store(df: DataFrame, path: str, day: str, groups: Sequence[str], keys: Mapping[str, Column], values: Mapping[str, Column],
          again: Sequence | None = None) -> None:
    """Add the days of ``df`` (a date column ``day``) that the table at ``path`` lacks; ``again`` names days to
    build anew, as when rows came late.  Null keys and values aren't counted; ``n`` counts all rows."""
    spark = df.sparkSession
    known = stored_days(spark, path, day)
    if known is not None:
        if again:
            known = known.filter(~F.col(day).isin(list(again)))
        df = df.join(F.broadcast(known), day, "left_anti")             # a calendar at most
    sketches = [F.hll_sketch_agg(c.cast("string"), LG_K).alias(f"distinct_{n}") for n, c in keys.items()]
    sketches += [F.kll_sketch_agg_double(c.cast("double"), KLL_K).alias(f"quantiles_{n}") for n, c in values.items()]
    daily = df.groupBy(day, *groups).agg(F.count(F.lit(1)).alias("n"), *sketches)
    (daily.repartitionByRange(day, *groups).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(day).parquet(path))


def distinct_over(stored: DataFrame, span: Sequence[str], key: str) -> DataFrame:
    """Rows and estimated distinct count of a key for each span of days (columns of ``stored``)."""
    merged = F.hll_union_agg(f"distinct_{key}", F.lit(False))
    return stored.groupBy(*span).agg(F.sum("n").alias("n"), F.hll_sketch_estimate(merged).alias("n_distinct"))


def quantiles_over(stored: DataFrame, span: Sequence[str], value: str, ranks: Sequence[float]) -> DataFrame:
    """Values counted and estimated quantiles (array ``q``, in the order of ``ranks``) for each span."""
    one = stored.groupBy(*span).agg(F.kll_merge_agg_double(f"quantiles_{value}").alias("_s"))
    found = [F.kll_sketch_get_quantile_double("_s", F.lit(float(r))) for r in ranks]
    n = F.kll_sketch_get_n_double("_s")
    return one.select(*span, n.alias("n_values"), F.when(n > 0, F.array(*found)).alias("q"))


def rank_errors(df: DataFrame, span: Sequence[str], value: Column, found: DataFrame, ranks: Sequence[float]) -> DataFrame:
    """How far each estimated quantile lies from its rank among all values, as a share of them (array ``errors``)."""
    both = df.select(*span, value.cast("double").alias("_v")).filter(F.col("_v").isNotNull()).join(found, list(span))
    counts = [c for i in range(len(ranks)) for c in (F.count_if(F.col("_v") < F.col("q")[i]).alias(f"_lt{i}"),
                                                     F.count_if(F.col("_v") <= F.col("q")[i]).alias(f"_le{i}"))]
    per = both.groupBy(*span).agg(F.count(F.lit(1)).alias("_n"), *counts)
    off = [F.greatest(F.lit(0.0), F.col(f"_lt{i}") / F.col("_n") - r, r - F.col(f"_le{i}") / F.col("_n")) for i, r in enumerate(ranks)]
    return per.select(*span, F.col("_n").alias("n_values"), F.array(*off).alias("errors"))
