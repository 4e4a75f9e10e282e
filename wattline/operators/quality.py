"""Data-quality checks.

Metrics are computed in one pass per table (a single aggregate with one expression per column)
and unpivoted to rows, so adding a column adds an expression, not a job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline import schemas
from wattline.functions.columns import dround, exact_sum, ratio


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """V2: (column, rows, nulls, null_pct) for every column, from one aggregate."""
    cols = list(cols or df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(F.col(c).isNull()).alias(f"_n_{i}") for i, c in enumerate(cols)])
    long = agg.unpivot(["_rows"], [f"_n_{i}" for i in range(len(cols))], "_c", "nulls")
    names = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(f"_n_{i}"), F.lit(c))])
    return long.select(F.element_at(names, F.col("_c")).alias("column_name"), F.col("_rows").alias("rows"),
                       "nulls", dround(ratio(F.col("nulls") * F.lit(100.0), "_rows"), 4).alias("null_pct"))


def duplicate_share(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """V3: rows, distinct keys and duplicate % = 100 x (1 - distinct / rows)."""
    a = df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(*[F.col(k) for k in keys]).alias("distinct_keys"))
    return a.select(F.lit(table).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"), "rows",
                    "distinct_keys",
                    dround(F.lit(100.0) - ratio(F.col("distinct_keys") * F.lit(100.0), "rows"), 4).alias("duplicate_pct"))


def freshness(df: DataFrame, table: str, ts: str, as_of: str) -> DataFrame:
    """V4: newest timestamp and hours since it at ``as_of``."""
    a = df.agg(F.max(ts).alias("max_ts"))
    hours = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(F.col("max_ts").cast("timestamp"))) / F.lit(3.6e9)
    return a.select(F.lit(table).alias("table_name"), "max_ts", dround(hours, 2).alias("freshness_hours"))


def row_counts(tables: Mapping[str, DataFrame], expected_min: int = schemas.MIN_ROWS) -> DataFrame:
    """A1/V5: row count per table from a tagged union (no columns are read), with the gate."""
    u = None
    for name, df in tables.items():
        t = df.select(F.lit(name).alias("table_name"))
        u = t if u is None else u.unionByName(t)
    c = u.groupBy("table_name").agg(F.count(F.lit(1)).alias("row_count"))
    return c.withColumns({"expected_min": F.lit(expected_min),
                          "ok": F.col("row_count") >= F.lit(expected_min)})


def load_totals(tables: Mapping[str, DataFrame]) -> DataFrame:
    """A2: rows per table plus the overall total (ROLLUP; the total row has a NULL table)."""
    u = None
    for name, df in tables.items():
        t = df.select(F.lit(name).alias("table_name"))
        u = t if u is None else u.unionByName(t)
    return u.rollup("table_name").agg(F.count(F.lit(1)).alias("rows"))


def violations(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """V6/V7/V8: (check, rows, violations) for boolean 'bad row' expressions, one aggregate."""
    names = list(checks)
    agg = df.agg(F.count(F.lit(1)).alias("rows"),
                 *[F.count_if(F.coalesce(checks[n], F.lit(False))).alias(f"_v{i}") for i, n in enumerate(names)])
    long = agg.unpivot(["rows"], [f"_v{i}" for i in range(len(names))], "_c", "violations")
    m = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(f"_v{i}"), F.lit(n))])
    return long.select(F.element_at(m, F.col("_c")).alias("check_name"), "rows", "violations")


def schema_check(spark: SparkSession, name: str, df: DataFrame, declared: Mapping[str, str]) -> DataFrame:
    """V1: declared vs actual columns: ok / missing / extra / type_mismatch (one row per column),
    each with the table's row count and ``non_empty``.  The column rows come from the schema
    (metadata); the count is one aggregate over the table (Parquet answers it from row-group
    footers), joined on the table name as a one-row broadcast side."""
    actual = {f.name: schemas.type_family(f.dataType) for f in df.schema.fields}
    rows = []
    for c, t in declared.items():
        a = actual.get(c)
        rows.append((name, c, t, a, "missing" if a is None else ("ok" if a == t else "type_mismatch")))
    for c, a in actual.items():
        if c not in declared:
            rows.append((name, c, None, a, "extra"))
    cols = spark.createDataFrame(
        rows, "table_name string, column_name string, declared_type string, actual_type string, status string")
    n = df.agg(F.count(F.lit(1)).alias("table_rows")).withColumn("table_name", F.lit(name))
    return (cols.join(F.broadcast(n), "table_name")
            .withColumn("non_empty", F.col("table_rows") > 0))


def verdicts(metrics: DataFrame, thresholds: DataFrame) -> DataFrame:
    """(env, metric, value, limit, verdict): fail when over the limit and the environment
    fails on warnings, warn when over otherwise, pass when within.  The threshold frame has a few
    rows per metric and is broadcast."""
    j = metrics.join(F.broadcast(thresholds), "metric")
    over = F.col("value") > F.col("limit")
    return j.select("env", "metric", "value", "limit",
                    F.when(over & F.col("fail_on_warn"), "fail").when(over, "warn").otherwise("pass").alias("verdict"))


def quarantine(df: DataFrame, key: Sequence[str], rules: Mapping[str, Column]) -> DataFrame:
    """Each row with its reject reasons (array of rule names) and is_good = no reason."""
    reasons = F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]),
                       lambda x: x.isNotNull())
    return df.select(*key, reasons.alias("reasons")).withColumn("is_good", F.size("reasons") == 0)


def reconcile_totals(a: DataFrame, b: DataFrame, keys: Sequence[str], tol: float) -> DataFrame:
    """Two aggregates (columns ``a_value``, ``b_value``) full-outer joined on the keys, the
    difference and whether it is within the tolerance."""
    j = a.join(b, list(keys), "full")
    diff = F.coalesce("a_value", F.lit(0.0)) - F.coalesce("b_value", F.lit(0.0))
    return j.select(*keys, "a_value", "b_value", dround(diff, 4).alias("diff"),
                    (F.abs(diff) <= F.lit(tol)).alias("ok"))


def profile(df: DataFrame, cols: Sequence[str], scale: int = 4) -> DataFrame:
    """Per numeric column: rows, min, max, mean, stddev (from exact sums) in one aggregate,
    and exact p50 / p95 from a distributed sort of the column (``derive.exact_quantiles``)."""
    from wattline.operators.derive import exact_quantiles
    exprs = []
    for i, c in enumerate(cols):
        v = F.col(c).cast(f"decimal(18,{scale})")
        exprs.append(F.struct(
            F.count(F.col(c)).alias("n"), F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"),
            F.sum(v).cast("double").alias("s1"), F.sum(v * v).cast("double").alias("s2")).alias(f"_p{i}"))
    a = df.agg(*exprs)
    long = a.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_p{i}").alias("p"))
                                        for i, c in enumerate(cols)])).alias("x")).select("x.column_name", "x.p.*")
    qs = None
    for c in cols:
        q = exact_quantiles(df, c, [0.5, 0.95]).select(
            F.lit(c).alias("column_name"), F.col("q0").cast("double").alias("p50"), F.col("q1").cast("double").alias("p95"))
        qs = q if qs is None else qs.unionByName(q)
    var = (F.col("s2") - F.col("s1") * F.col("s1") / F.col("n")) / (F.col("n") - 1)
    stats = long.select("column_name", "n", "min", "max", dround(F.col("s1") / F.col("n"), 6).alias("mean"),
                        dround(F.when(var > 0, F.sqrt(var)).otherwise(F.lit(0.0)), 6).alias("stddev"))
    return stats.join(qs, "column_name")


def distinct_coverage(df: DataFrame, group: str, cols: Mapping[str, Column]) -> DataFrame:
    """Exact distinct counts per group (``approx_count_distinct`` is the choice for very wide
    keys where an estimate is acceptable)."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("rows"),
                                 *[F.count_distinct(c).alias(n) for n, c in cols.items()])


def match_rate(a: DataFrame, b: DataFrame, key: str, left: str, right: str, rel_tol: float,
               target: float) -> DataFrame:
    """Share of keys whose two values agree within a relative tolerance, and the verdict."""
    j = a.join(b, key)
    ok = F.abs(F.col(left) - F.col(right)) <= F.lit(rel_tol) * F.abs(F.col(right))
    r = j.agg(F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("matched"))
    rate = ratio("matched", "n")
    return r.select("n", "matched", dround(rate, 6).alias("match_rate"),
                    F.when(rate >= F.lit(target), "pass").otherwise("fail").alias("verdict"))
