"""Data-quality queries (V1-V18, A1, A2, A20, U3) bound to the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattline import schemas
from wattline.functions.columns import day, exact_sum, month
from wattline.operators import quality as Q
from wattline.plans import bronze_plans, derive_plans, gold_plans
from wattline.plans.registry import ORACLE, register
from wattline.plans.sqlparts import day_of, month_of, num, xs
from wattline.plans.sqlparts import dround as sround
from wattline.plans.views import with_views
from wattline.session import materialized
from wattline.sources import bronze as B
from wattline.sources import messages as M
from wattline.sources import tables as T

AS_OF_TELEMETRY = "2024-02-01 00:00:00"
FUTURE_CUTOFF = "2024-01-20 00:00:00"
DRIVER = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
DISPATCH_COLS = ["node_id", "day", "generation_mwh", "curtailed_mwh", "demand_mwh", "curtailment_rate",
                 "net_balance_mwh"]


def _sub(name: str) -> str:
    return f"({ORACLE[name]})"


def _nulls_sql() -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) AS rows, COUNT_IF({c} IS NULL) AS nulls FROM fd" for c in DISPATCH_COLS)
    return (f"WITH fd AS {_sub('fact_dispatch_node_day')}\n"
            f"SELECT column_name, rows, nulls, {sround(f'nulls * {num(100.0)} / NULLIF(rows, 0)', 4)} AS null_pct "
            f"FROM ({parts})")


@register("dq_nulls", _nulls_sql(), "V2")
def dq_nulls(spark, sf):
    return Q.null_profile(gold_plans.fact_dispatch_node_day(spark, sf), DISPATCH_COLS)


_DUP_KEYS = [("generation", ["plant_id", "ts"]), ("telemetry", ["node_id", "ts"]), ("demand", ["node_id", "ts"])]


def _dup_sql() -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{','.join(k)}' AS key_columns, (SELECT COUNT(*) FROM {t}) AS rows, "
        f"(SELECT COUNT(*) FROM (SELECT DISTINCT {', '.join(k)} FROM {t})) AS distinct_keys" for t, k in _DUP_KEYS)
    return (with_views("generation", "telemetry", "demand") +
            f"SELECT *, {sround(f'{num(100.0)} - distinct_keys * {num(100.0)} / NULLIF(rows, 0)', 4)} AS duplicate_pct "
            f"FROM ({parts})")


def _views(spark, sf):
    return {"generation": T.generation(spark, sf), "telemetry": T.telemetry(spark, sf), "demand": T.demand(spark, sf)}


@register("dq_duplicates", _dup_sql(), "V3")
def dq_duplicates(spark, sf):
    v = _views(spark, sf)
    out = None
    for t, k in _DUP_KEYS:
        d = Q.duplicate_share(v[t], t, k)
        out = d if out is None else out.unionByName(d)
    return out


def _fresh_sql() -> str:
    parts = " UNION ALL ".join(f"SELECT '{t}' AS table_name, MAX(ts) AS max_ts FROM {t}" for t in _views_names())
    hrs = f"(epoch_us(TIMESTAMP '{AS_OF_TELEMETRY}') - epoch_us(max_ts)) / {num(3.6e9)}"
    return with_views("generation", "telemetry", "demand") + f"SELECT table_name, max_ts, {sround(hrs, 2)} AS freshness_hours FROM ({parts})"


def _views_names():
    return ["generation", "telemetry", "demand"]


@register("dq_freshness", _fresh_sql(), "V4")
def dq_freshness(spark, sf):
    v = _views(spark, sf)
    out = None
    for t in _views_names():
        d = Q.freshness(v[t], t, "ts", AS_OF_TELEMETRY)
        out = d if out is None else out.unionByName(d)
    return out


_rc_union = " UNION ALL ".join(f"SELECT '{t}' AS table_name FROM {t}" for t in DRIVER)


@register("dq_row_counts", f"""
SELECT table_name, COUNT(*) AS row_count, {schemas.MIN_ROWS} AS expected_min, COUNT(*) >= {schemas.MIN_ROWS} AS ok
FROM ({_rc_union}) GROUP BY 1""", "A1 V5 O2")
def dq_row_counts(spark, sf):
    return Q.row_counts({t: T.scan(spark, sf, t) for t in DRIVER})


@register("load_totals", f"""
SELECT table_name, COUNT(*) AS rows FROM ({_rc_union}) GROUP BY ROLLUP (table_name)""", "A2")
def load_totals(spark, sf):
    return Q.load_totals({t: T.scan(spark, sf, t) for t in DRIVER})


_RANGE_CHECKS = {
    "mwh_negative": ("mwh < 0", lambda: F.col("mwh") < 0),
    "curtail_rate_outside_unit": ("NOT (curtail_rate BETWEEN 0 AND 1)", lambda: ~F.col("curtail_rate").between(0, 1)),
    "spot_adj_outside_range": (f"NOT (spot_adj BETWEEN 0 AND {num(0.1)})", lambda: ~F.col("spot_adj").between(0.0, 0.1)),
    "revenue_non_positive": ("revenue <= 0", lambda: F.col("revenue") <= 0),
}


def _viol_sql(view: str, checks: dict, src: str | None = None) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{n}' AS check_name, COUNT(*) AS rows, COUNT_IF(COALESCE({s}, false)) AS violations FROM {view}"
        for n, (s, _) in checks.items())
    return parts


_FACTOR_CHECK = {"capacity_factor_outside_unit": (
    "NOT (capacity_factor BETWEEN 0 AND 1)", lambda: ~F.col("capacity_factor").between(0, 1))}


@register("dq_ranges", with_views("generation") + _viol_sql("generation", _RANGE_CHECKS) + " UNION ALL "
          + _viol_sql(_sub("capacity_factor"), _FACTOR_CHECK), "V6")
def dq_ranges(spark, sf):
    """The ranges of the rows, and of the daily capacity factor of each plant."""
    rows = Q.violations(T.generation(spark, sf), {n: f() for n, (_, f) in _RANGE_CHECKS.items()})
    factor = derive_plans.capacity_factor(spark, sf)
    return rows.unionByName(Q.violations(factor, {n: f() for n, (_, f) in _FACTOR_CHECK.items()}))


_TS_CHECKS = {
    "future": (f"ts > TIMESTAMP '{FUTURE_CUTOFF}'", lambda: F.col("ts") > F.lit(FUTURE_CUTOFF).cast("timestamp_ntz")),
    "unparsable": ("ts IS NULL", lambda: F.col("ts").isNull()),
    "off_grid_5min": ("(second(ts) <> 0 OR minute(ts) % 5 <> 0 OR microsecond(ts) % 1000000 <> 0)",
                      lambda: (F.second("ts") != 0) | (F.minute("ts") % 5 != 0)
                      | (F.unix_micros(F.col("ts").cast("timestamp")) % 1_000_000 != 0)),
}


@register("dq_timestamps", with_views("telemetry") + _viol_sql("telemetry", _TS_CHECKS), "V7")
def dq_timestamps(spark, sf):
    return Q.violations(T.telemetry(spark, sf), {n: f() for n, (_, f) in _TS_CHECKS.items()})


_tot = " + ".join(f'COALESCE("{f}", {num(0.0)})' for f in derive_plans.FLAGS)
_EB_CHECKS = {
    "total_vs_sources": (f"abs(total_generation_mw - ({_tot})) > {num(0.1)}",
                         lambda: F.abs(F.col("total_generation_mw")
                                       - sum((F.coalesce(F.col(f), F.lit(0.0)) for f in derive_plans.FLAGS), F.lit(0.0)))
                         > F.lit(0.1)),
    "balance_vs_generation_minus_demand": (f"abs(balance_mw - (total_generation_mw - demand_mwh)) > {num(0.1)}",
                                           lambda: F.abs(F.col("balance_mw") - (F.col("total_generation_mw")
                                                                                 - F.col("demand_mwh"))) > F.lit(0.1)),
}


@register("dq_energy_balance", f"WITH dd AS {_sub('derive_dispatch')}\n" + _viol_sql("dd", _EB_CHECKS), "V8")
def dq_energy_balance(spark, sf):
    return Q.violations(derive_plans.derive_dispatch(spark, sf), {n: f() for n, (_, f) in _EB_CHECKS.items()})


def _schema_sql() -> str:
    decl = " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{ty}' AS declared_type"
                              for t, cols in schemas.DRIVER_TYPES.items() for c, ty in cols.items())
    fam = ("CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' "
           "WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp' WHEN 'DATE' THEN 'date' "
           "ELSE lower(data_type) END")
    tabs = ", ".join(f"'{t}'" for t in schemas.DRIVER_TYPES)
    counts = " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS table_rows FROM {t}"
                                for t in schemas.DRIVER_TYPES)
    return f"""
WITH d AS ({decl}),
a AS (SELECT DISTINCT table_name, column_name, {fam} AS actual_type FROM information_schema.columns
      WHERE table_name IN ({tabs})),
c AS (SELECT COALESCE(d.table_name, a.table_name) AS table_name, COALESCE(d.column_name, a.column_name) AS column_name,
       declared_type, actual_type,
       CASE WHEN actual_type IS NULL THEN 'missing' WHEN declared_type IS NULL THEN 'extra'
            WHEN declared_type = actual_type THEN 'ok' ELSE 'type_mismatch' END AS status
FROM d FULL OUTER JOIN a ON d.table_name = a.table_name AND d.column_name = a.column_name),
n AS ({counts})
SELECT c.*, n.table_rows, n.table_rows > 0 AS non_empty FROM c JOIN n USING (table_name)"""


@register("dq_schema", _schema_sql(), "V1")
def dq_schema(spark, sf):
    out = None
    for t, decl in schemas.DRIVER_TYPES.items():
        d = Q.schema_check(spark, t, T.scan(spark, sf, t), decl)
        out = d if out is None else out.unionByName(d)
    return out


SECTORS = ["AUTOMOBILE", "BUILDING", "FURNITURE"]


@register("dq_sector_shares", with_views("demand", extra=f"""
s AS (SELECT node_id, {day_of('ts')} AS day, {xs('demand_mw', 6)} AS total,
             {', '.join(f"{xs(f'CASE WHEN dataset = {chr(39)}{x}{chr(39)} THEN demand_mw END', 6)} AS s{i}" for i, x in enumerate(SECTORS))}
      FROM demand GROUP BY 1, 2),
p AS (SELECT node_id, day, {' + '.join(f'COALESCE(s{i} * {num(100.0)} / total, {num(0.0)})' for i in range(len(SECTORS)))} AS share_sum FROM s)""") + f"""
SELECT node_id, day, {sround('share_sum', 2)} AS share_sum,
       CASE WHEN abs(share_sum - {num(100.0)}) > {num(1.0)} THEN 'warn' ELSE 'pass' END AS status FROM p""", "V10")
def dq_sector_shares(spark, sf):
    d = T.demand(spark, sf)
    s = d.groupBy("node_id", day("ts").alias("day")).agg(
        exact_sum("demand_mw", 6, "total"),
        *[exact_sum(F.when(F.col("dataset") == x, F.col("demand_mw")), 6, f"s{i}") for i, x in enumerate(SECTORS)])
    share = sum((F.coalesce(F.col(f"s{i}") * F.lit(100.0) / F.col("total"), F.lit(0.0)) for i in range(len(SECTORS))),
                F.lit(0.0))
    from wattline.functions.columns import dround
    return s.select("node_id", "day", share.alias("_s")).select(
        "node_id", "day", dround("_s", 2).alias("share_sum"),
        F.when(F.abs(F.col("_s") - F.lit(100.0)) > F.lit(1.0), "warn").otherwise("pass").alias("status"))


def _thr_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{e}' AS env, '{m}' AS metric, {num(v)} AS \"limit\", {str(schemas.FAIL_ON_WARN[e]).lower()} AS fail_on_warn"
        for e, m, v in schemas.THRESHOLDS)


@register("dq_verdict", f"""
WITH m AS (
  SELECT 'null_pct' AS metric, (SELECT MAX(null_pct) FROM {_sub('dq_nulls')}) AS value
  UNION ALL SELECT 'duplicate_pct', (SELECT MAX(duplicate_pct) FROM {_sub('dq_duplicates')})
  UNION ALL SELECT 'freshness_hours', (SELECT freshness_hours FROM {_sub('dq_freshness')} WHERE table_name = 'telemetry')),
t AS ({_thr_sql()})
SELECT env, m.metric, value, "limit",
       CASE WHEN value > "limit" AND fail_on_warn THEN 'fail' WHEN value > "limit" THEN 'warn' ELSE 'pass' END AS verdict
FROM m JOIN t ON m.metric = t.metric""", "V11")
def dq_verdict(spark, sf):
    nulls = dq_nulls(spark, sf).agg(F.max("null_pct").alias("value")).select(F.lit("null_pct").alias("metric"), "value")
    dups = dq_duplicates(spark, sf).agg(F.max("duplicate_pct").alias("value")).select(
        F.lit("duplicate_pct").alias("metric"), "value")
    fresh = dq_freshness(spark, sf).filter(F.col("table_name") == "telemetry").select(
        F.lit("freshness_hours").alias("metric"), F.col("freshness_hours").alias("value"))
    metrics = nulls.unionByName(dups).unionByName(fresh)
    thr = spark.createDataFrame([(e, m, v, schemas.FAIL_ON_WARN[e]) for e, m, v in schemas.THRESHOLDS],
                                "env string, metric string, limit double, fail_on_warn boolean")
    return Q.verdicts(metrics, thr)


_Q_RULES = {
    "non_positive_mwh": ("mwh <= 0", lambda: F.col("mwh") <= 0),
    "high_curtailment": (f"curtail_rate > {num(0.09)}", lambda: F.col("curtail_rate") > F.lit(0.09)),
    "future_ts": ("ts > TIMESTAMP '2001-01-01 00:00:00'",
                  lambda: F.col("ts") > F.lit("2001-01-01 00:00:00").cast("timestamp_ntz")),
    "rejected_flag": ("flag = 'R'", lambda: F.col("flag") == "R"),
}


@register("quarantine_split", with_views("generation") + f"""
SELECT gen_order, gen_line, reasons, len(reasons) = 0 AS is_good FROM (
  SELECT gen_order, gen_line,
         list_filter([{', '.join(f"CASE WHEN COALESCE({s}, false) THEN '{n}' END" for n, (s, _) in _Q_RULES.items())}],
                     lambda x: x IS NOT NULL) AS reasons
  FROM generation)""", "V12 F5")
def quarantine_split(spark, sf):
    return Q.quarantine(T.generation(spark, sf), ["gen_order", "gen_line"], {n: f() for n, (_, f) in _Q_RULES.items()})


_DAY_SUM = sround("SUM(CAST(metric AS DECIMAL(28,4)))", 4)


@register("reconciliation", bronze_plans.MSG_SQL + f""", t AS ({bronze_plans.ALL_TABLES_SQL}),
src AS (SELECT CASE topic {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in schemas.TOPIC_TABLE.items())} END AS table_name,
               COUNT(*) AS source_rows, {xs('mw', 4)} AS source_value,
               COUNT_IF(error_message IS NOT NULL OR k IN {bronze_plans.ROW_REJECT}) AS dead_rows FROM mm GROUP BY 1),
br AS (SELECT table_name, COUNT(*) AS bronze_rows, {xs('metric', 4)} AS bronze_value FROM t GROUP BY 1),
gold AS (SELECT table_name, {xs('day_value', 4)} AS gold_value FROM (
           SELECT table_name, entity, event_date, {_DAY_SUM} AS day_value FROM t WHERE _dataset <> 'unknown' GROUP BY 1, 2, 3)
         GROUP BY 1)
SELECT table_name, source_rows, bronze_rows, dead_rows, source_rows = bronze_rows + dead_rows AS rows_ok,
       source_value, bronze_value, gold_value, abs(source_value - bronze_value) <= {num(0.01)} AS source_ok,
       abs(bronze_value - gold_value) <= {num(0.01)} AS gold_ok
FROM src JOIN br USING (table_name) JOIN gold USING (table_name)""", "V13")
def reconciliation(spark, sf):
    """Source, Bronze and Gold of each feed, each from its own storage: every source row must have
    landed or be a dead letter, and the metric must add up.  It doesn't where values were lost: rows
    rejected on the way to Bronze, rows of unknown dataset on the way to the daily Gold sums."""
    root = bronze_plans.bronze_root(spark, sf)
    topics = F.create_map(*[F.lit(x) for kv in schemas.TOPIC_TABLE.items() for x in kv])
    feed = F.create_map(*[F.lit(x) for kv in M.TOPIC_OF_SOURCE.items() for x in kv])
    src = T.telemetry(spark, sf).groupBy(F.element_at(topics, F.element_at(feed, F.col("source_type"))).alias("table_name")).agg(
        F.count(F.lit(1)).alias("source_rows"), exact_sum("mw", 4, "source_value"))
    dead = B.read_table(spark, root, "dead_letter_queue").groupBy(F.element_at(topics, F.col("topic")).alias("table_name")).agg(
        F.count(F.lit(1)).alias("dead_rows"))
    bronze = B.all_tables(spark, root)
    landed = bronze.groupBy("table_name").agg(F.count(F.lit(1)).alias("bronze_rows"), exact_sum("metric", 4, "bronze_value"))
    daily = materialized(bronze.filter("_dataset <> 'unknown'").groupBy("table_name", "entity", "event_date").agg(
        exact_sum("metric", 4, "day_value")), "gold_days")
    gold = daily.groupBy("table_name").agg(exact_sum("day_value", 4, "gold_value"))
    j = src.join(landed, "table_name").join(gold, "table_name").join(dead, "table_name", "left")
    lost = F.coalesce("dead_rows", F.lit(0))
    return j.select("table_name", "source_rows", "bronze_rows", lost.alias("dead_rows"),
                    (F.col("source_rows") == F.col("bronze_rows") + lost).alias("rows_ok"), "source_value", "bronze_value", "gold_value",
                    (F.abs(F.col("source_value") - F.col("bronze_value")) <= F.lit(0.01)).alias("source_ok"),
                    (F.abs(F.col("bronze_value") - F.col("gold_value")) <= F.lit(0.01)).alias("gold_ok"))


PROFILE_COLS = ["mwh", "revenue", "curtail_rate", "spot_adj"]


def _profile_sql() -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT({c}) AS n, CAST(MIN({c}) AS DOUBLE) AS min, CAST(MAX({c}) AS DOUBLE) AS max, "
        f"CAST(SUM(CAST({c} AS DECIMAL(18,4))) AS DOUBLE) AS s1, "
        f"CAST(SUM(CAST({c} AS DECIMAL(38,4)) * CAST({c} AS DECIMAL(38,4))) AS DOUBLE) AS s2, "
        f"CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS p50, CAST(quantile_disc({c}, 0.95) AS DOUBLE) AS p95 FROM generation"
        for c in PROFILE_COLS)
    var = "(s2 - s1 * s1 / n) / (n - 1)"
    return with_views("generation") + (
        f"SELECT column_name, n, min, max, {sround('s1 / n', 6)} AS mean, "
        f"{sround(f'CASE WHEN {var} > 0 THEN sqrt({var}) ELSE {num(0.0)} END', 6)} AS stddev, p50, p95 FROM ({parts})")


@register("column_profile", _profile_sql(), "V15")
def column_profile(spark, sf):
    return Q.profile(T.generation(spark, sf), PROFILE_COLS)


@register("meter_balance", with_views("generation", "plants", "demand") + f"""
, a AS (SELECT node_id, {month_of('ts')} AS month, {xs('demand_mw', 6)} AS a_value FROM demand GROUP BY 1, 2),
b AS (SELECT node_id, {month_of('g.ts')} AS month, {xs('mwh', 2)} AS b_value
      FROM generation g JOIN plants p USING (plant_id) GROUP BY 1, 2)
SELECT node_id, month, a_value, b_value,
       {sround(f'COALESCE(a_value, {num(0.0)}) - COALESCE(b_value, {num(0.0)})', 4)} AS diff,
       abs(COALESCE(a_value, {num(0.0)}) - COALESCE(b_value, {num(0.0)})) <= {num(50.0)} AS ok
FROM a FULL OUTER JOIN b USING (node_id, month)""", "V17")
def meter_balance(spark, sf):
    a = T.demand(spark, sf).groupBy("node_id", month("ts").alias("month")).agg(exact_sum("demand_mw", 6, "a_value"))
    g = T.generation(spark, sf).select("plant_id", month("ts").alias("month"), "mwh")
    b = (g.join(T.plants(spark, sf).select("plant_id", "node_id"), "plant_id")
         .groupBy("node_id", "month").agg(exact_sum("mwh", 2, "b_value")))
    return Q.reconcile_totals(a, b, ["node_id", "month"], 50.0)


@register("match_rate", f"""
WITH b AS (SELECT l_orderkey AS o_orderkey,
                  {xs('l_extendedprice * (1 + l_tax) * (1 - l_discount)', 8)} AS computed
           FROM lineitem GROUP BY 1),
j AS (SELECT o_totalprice, computed FROM orders JOIN b USING (o_orderkey)),
r AS (SELECT COUNT(*) AS n, COUNT_IF(abs(o_totalprice - computed) <= {num(0.01)} * abs(computed)) AS matched FROM j)
SELECT n, matched, {sround('matched / NULLIF(n, 0)', 6)} AS match_rate,
       CASE WHEN matched / NULLIF(n, 0) >= {num(0.99)} THEN 'pass' ELSE 'fail' END AS verdict FROM r""", "V18")
def match_rate(spark, sf):
    li = T.scan(spark, sf, "lineitem")
    b = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        exact_sum(F.col("l_extendedprice") * (F.lit(1) + F.col("l_tax")) * (F.lit(1) - F.col("l_discount")), 8,
                  "computed"))
    a = T.scan(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return Q.match_rate(a, b, "o_orderkey", "o_totalprice", "computed", 0.01, 0.99)


@register("distinct_coverage", with_views("demand") + """
SELECT dataset, COUNT(*) AS rows, COUNT(DISTINCT node_id) AS n_nodes, COUNT(DISTINCT CAST(ts AS DATE)) AS n_days
FROM demand GROUP BY 1""", "A20")
def distinct_coverage(spark, sf):
    return Q.distinct_coverage(T.demand(spark, sf), "dataset",
                               {"n_nodes": F.col("node_id"), "n_days": F.to_date("ts")})


@register("replay_audit", with_views("generation") + """
, a AS (SELECT plant_id, ts FROM generation WHERE status = 'F'),
b AS (SELECT plant_id, ts FROM generation WHERE status = 'O')
SELECT 'only_first' AS side, plant_id, ts FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
UNION ALL
SELECT 'only_second', plant_id, ts FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)
UNION ALL
SELECT 'both', plant_id, ts FROM (SELECT * FROM a INTERSECT SELECT * FROM b)""", "U3")
def replay_audit(spark, sf):
    """Keys present in one load and not the other (EXCEPT ALL, both ways) and keys in both (INTERSECT);
    the two 'loads' are the finished and open lines of the generation view."""
    g = T.generation(spark, sf)
    a = g.filter(F.col("status") == "F").select("plant_id", "ts")
    b = g.filter(F.col("status") == "O").select("plant_id", "ts")
    only = a.exceptAll(b).select(F.lit("only_first").alias("side"), "plant_id", "ts")
    second = b.exceptAll(a).select(F.lit("only_second").alias("side"), "plant_id", "ts")
    both = a.intersect(b).select(F.lit("both").alias("side"), "plant_id", "ts")
    return only.unionByName(second).unionByName(both)
