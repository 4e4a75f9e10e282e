"""Derived-column queries (P7-P25, F2, F4, V14) bound to the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattline.functions import curves as C
from wattline.functions.columns import day, dround, exact_sum, hour_ts, ratio
from wattline.operators import derive as D
from wattline.operators import gold
from wattline.plans.registry import register
from wattline.plans.sqlparts import day_of, dround as sround, num, xs
from wattline.plans.sqlparts import hour_ts as sql_hour
from wattline.plans.sqlparts import ratio as sql_ratio
from wattline.plans.views import with_views
from wattline.session import materialized
from wattline.sources import tables as T

# Fixed values of the bindings.
FLAGS = ["A", "N", "R"]                       # generation "sources" = return flags
SOURCE_OF = {"click": "solar", "view": "wind", "purchase": "hydro", "signup": "geothermal", "error": "tidal"}
CLIMATES = list(C.CLIMATE_SOLAR) + ["volcanic"]   # node climate = CLIMATES[node_id mod 14]
CURRENCY_OF = {"AUTOMOBILE": "usd", "BUILDING": "usd", "FURNITURE": "gil", "HOUSEHOLD": "gil",
               "MACHINERY": "usd"}
REGION_TZ = {"AFRICA": "Africa/Johannesburg", "AMERICA": "America/Santiago", "ASIA": "Asia/Tokyo",
             "EUROPE": "Europe/Madrid", "MIDDLE EAST": "Asia/Dubai"}
SALT = "wattline"


def _case(col: str, table: dict, default=None, as_double=True) -> str:
    parts = " ".join(f"WHEN '{k}' THEN {num(v) if as_double else repr(v)}" for k, v in table.items())
    d = "NULL" if default is None else (num(default) if as_double else repr(default))
    return f"(CASE {col} {parts} ELSE {d} END)"


def _climate_col(node_id):
    arr = F.array(*[F.lit(c) for c in CLIMATES])
    return F.element_at(arr, (F.pmod(node_id, F.lit(len(CLIMATES))) + 1).cast("int"))


_CLIMATE_SQL = "([" + ", ".join(f"'{c}'" for c in CLIMATES) + f"])[(node_id % {len(CLIMATES)}) + 1]"


@register("capacity_factor", with_views("generation", "plants", extra=f"""
pd AS (SELECT plant_id, {day_of('ts')} AS day, {xs('mwh', 2)} AS mwh FROM generation GROUP BY 1, 2)""") + f"""
SELECT pd.plant_id, day, mwh, capacity_mw, {sql_ratio('mwh', f'capacity_mw * {num(24.0)}')} AS capacity_factor
FROM pd JOIN plants p ON pd.plant_id = p.plant_id""", "P16")
def capacity_factor(spark, sf):
    g = T.generation(spark, sf)
    pd = g.groupBy("plant_id", day("ts").alias("day")).agg(exact_sum("mwh", 2, "mwh"))
    p = T.plants(spark, sf).select("plant_id", "capacity_mw")
    return pd.join(p, "plant_id").withColumn(
        "capacity_factor", ratio("mwh", F.col("capacity_mw") * F.lit(24.0)))


_flag_sql = ", ".join(
    f"CAST(SUM(CASE WHEN flag = '{f}' THEN CAST(mwh AS DECIMAL(28,2)) END) AS DOUBLE) AS \"{f}\"" for f in FLAGS)
_tot = sround(" + ".join(f'COALESCE("{f}", {num(0.0)})' for f in FLAGS), 1)


@register("derive_dispatch", with_views("generation", "plants", "demand", extra=f"""
gw AS (SELECT node_id, {day_of('g.ts')} AS day, {_flag_sql}
       FROM generation g JOIN plants p USING (plant_id) GROUP BY 1, 2),
dnd AS (SELECT node_id, {day_of('ts')} AS day, {xs('demand_mw', 6)} AS demand_mwh FROM demand GROUP BY 1, 2),
b AS (SELECT gw.*, demand_mwh, {num(40.0)} + node_id AS ppa_price, {_tot} AS total_generation_mw
      FROM gw JOIN dnd USING (node_id, day)),
c AS (SELECT *, {sround('total_generation_mw - demand_mwh', 1)} AS balance_mw FROM b),
d AS (SELECT *, {sround(f'greatest({num(0.0)}, balance_mw * {num(0.3)})', 1)} AS curtailment_mw,
             {sround(f'ppa_price * demand_mwh / CASE WHEN total_generation_mw > 0 THEN total_generation_mw ELSE {num(1.0)} END', 2)} AS spot_price,
             {sround('total_generation_mw * ppa_price', 2)} AS revenue,
             {sround(f'total_generation_mw * {num(0.42)}', 2)} AS carbon_offset_tco2e FROM c)""") + f"""
SELECT *, {sround('curtailment_mw * ppa_price', 2)} AS curtailment_cost FROM d""", "P7 P8 P9 P10 P11 P12 J2")
def derive_dispatch(spark, sf):
    g = T.generation(spark, sf).select("plant_id", day("ts").alias("day"), "flag",
                                       F.col("mwh").cast("decimal(28,2)").alias("mwh"))
    gw = (g.join(T.plants(spark, sf).select("plant_id", "node_id"), "plant_id")
          .groupBy("node_id", "day").pivot("flag", FLAGS).agg(F.sum("mwh")))
    gw = gw.select("node_id", "day", *[F.col(f).cast("double").alias(f) for f in FLAGS])
    dnd = gold.node_day_demand(T.demand(spark, sf))
    j = gw.join(dnd, ["node_id", "day"])
    return D.dispatch_measures(j, FLAGS, "demand_mwh", F.lit(40.0) + F.col("node_id"))


_uw = ", ".join(
    f"CAST(COALESCE(SUM(CASE WHEN flag = '{f}' THEN CAST(mwh AS DECIMAL(28,2)) END), 0) AS DOUBLE) AS \"{f}\""
    for f in FLAGS)
_uu = " UNION ALL ".join(f"SELECT plant_id, year, '{f}' AS source_type, \"{f}\" AS mwh FROM w" for f in FLAGS)


@register("unpivot_sources", with_views("generation", extra=f"""
w AS (SELECT plant_id, CAST(year(ts) AS INTEGER) AS year, {_uw} FROM generation GROUP BY 1, 2)""") + f"""
SELECT * FROM ({_uu}) WHERE mwh IS NOT NULL AND mwh <> 0""", "P13 F2")
def unpivot_sources(spark, sf):
    g = T.generation(spark, sf).select("plant_id", F.year("ts").alias("year"), "flag",
                                       F.col("mwh").cast("decimal(28,2)").alias("mwh"))
    w = g.groupBy("plant_id", "year").pivot("flag", FLAGS).agg(F.sum("mwh"))
    w = w.select("plant_id", "year", *[F.coalesce(F.col(f), F.lit(0)).cast("double").alias(f) for f in FLAGS])
    return D.unpivot_sources(w, ["plant_id", "year"], FLAGS, "source_type", "mwh")


_UNITS_SQL = """u AS (SELECT plant_id, capacity_mw, CAST(greatest(1, floor(capacity_mw / 100)) AS INTEGER) AS n_units
      FROM plants),
s AS (SELECT plant_id, capacity_mw, n_units, CAST(unnest(generate_series(1, n_units)) AS INTEGER) AS unit_no FROM u)"""


@register("split_units", with_views("plants", extra=_UNITS_SQL) + f"""
SELECT plant_id, capacity_mw, n_units, unit_no, {sround('capacity_mw / n_units', 1)} AS unit_capacity_mw FROM s""",
          "P14")
def split_units(spark, sf):
    p = T.plants(spark, sf).select("plant_id", "capacity_mw")
    return D.split_units(p, "capacity_mw", 100)


@register("surrogate_id", with_views("plants", extra=_UNITS_SQL) + """
SELECT plant_id, unit_no, printf('PLT-%04d', row_number() OVER (ORDER BY plant_id, unit_no)) AS plant_code
FROM s""", "P15")
def surrogate_id(spark, sf):
    p = T.plants(spark, sf).select("plant_id", "capacity_mw")
    u = D.split_units(p, "capacity_mw", 100).select("plant_id", "unit_no")
    return D.surrogate_ids(u, ["plant_id", "unit_no"], "PLT", 4, "plant_code")


@register("currency_columns", with_views("demand") + f"""
SELECT reading_id, dataset, demand_mw, {_case('dataset', CURRENCY_OF, as_double=False)} AS currency,
       CASE WHEN {_case('dataset', CURRENCY_OF, as_double=False)} = 'usd' THEN demand_mw END AS demand_mw_usd,
       CASE WHEN {_case('dataset', CURRENCY_OF, as_double=False)} = 'gil' THEN demand_mw END AS demand_mw_gil
FROM demand""", "P17 B13")
def currency_columns(spark, sf):
    d = T.demand(spark, sf).select("reading_id", "dataset", "demand_mw")
    return D.currency_columns(d, "demand_mw", "dataset", CURRENCY_OF)


@register("utc_normalize", with_views("demand", "nodes") + f"""
SELECT reading_id, d.ts, {_case('region', REGION_TZ, as_double=False)} AS tz,
       CAST(timezone('UTC', timezone({_case('region', REGION_TZ, as_double=False)}, d.ts)) AS TIMESTAMP) AS ts_utc
FROM demand d JOIN nodes n ON d.node_id = n.node_id""", "P18")
def utc_normalize(spark, sf):
    d = T.demand(spark, sf).select("reading_id", "node_id", "ts")
    n = F.broadcast(T.nodes(spark, sf).select("node_id", "region"))
    tzmap = F.create_map(*[x for k, v in REGION_TZ.items() for x in (F.lit(k), F.lit(v))])
    j = d.join(n, "node_id").withColumn("tz", F.element_at(tzmap, F.col("region")))
    return D.utc_normalize(j, "ts", F.col("tz")).select("reading_id", "ts", "tz", "ts_utc")


def _source_case_sql(col):
    return _case(col, SOURCE_OF, as_double=False)


def _curve_sql(src: str, h: str, clim: str) -> str:
    """SQL mirror of ``curves.source_curve`` (kept next to its use so the two stay aligned)."""
    sf_ = _case(clim, C.CLIMATE_SOLAR, C.SOLAR_DEFAULT)
    wf = _case(clim, C.CLIMATE_WIND, C.WIND_DEFAULT)
    import math
    two_pi = num(2 * math.pi)
    solar = (f"CASE WHEN {h} < 5 OR {h} > 20 THEN {num(0.0)} ELSE "
             f"exp({num(-0.5)} * pow(({h} - 13) / {num(3.5)}, 2)) * {sf_} * {num(1.0)} END")
    wind = (f"({num(0.22)} + {num(0.18)} * sin({h} / {num(24.0)} * {two_pi})) * "
            f"CASE WHEN {h} < 6 OR {h} > 20 THEN {num(1.3)} ELSE {num(0.85)} END * {wf} * {num(1.0)}")
    hydro = f"({num(0.55)} + {num(0.2)} * sin(({h} - 8) / {num(24.0)} * {two_pi})) * {num(1.0)}"
    geo = num(0.9)
    tidal = f"({num(0.4)} + {num(0.3)} * abs(sin({h} / {num(12.42)} * {two_pi}))) * {num(1.0)}"
    return (f"CASE {src} WHEN 'solar' THEN {solar} WHEN 'wind' THEN {wind} WHEN 'hydro' THEN {hydro} "
            f"WHEN 'geothermal' THEN {geo} WHEN 'tidal' THEN {tidal} END")


def _band_sql(src: str, end: int) -> str:
    return "CASE " + src + " " + " ".join(
        f"WHEN '{s}' THEN {num(v[end])}" for s, v in C.BANDS.items()) + " END"


@register("expected_output_band", with_views("telemetry", extra=f"""
t AS (SELECT msg_offset, node_id, {_source_case_sql('source_type')} AS source, mw,
             CAST(hour(ts) AS INTEGER) AS h, {_CLIMATE_SQL} AS climate,
             MAX(mw) OVER (PARTITION BY node_id, source_type) AS cap FROM telemetry),
e AS (SELECT *, cap * ({_curve_sql('source', 'h', 'climate')}) AS curve FROM t),
b AS (SELECT msg_offset, node_id, source, mw, {sround('curve', 4)} AS expected,
             {sround(f"curve * {_band_sql('source', 0)}", 4)} AS band_lo,
             {sround(f"curve * {_band_sql('source', 1)}", 4)} AS band_hi FROM e)""") + """
SELECT *, mw BETWEEN band_lo AND band_hi AS in_band FROM b""", "P19 P21 F4 V14")
def expected_output_band(spark, sf):
    t = T.telemetry(spark, sf)
    # installed capacity ~ the observed peak of each (node, source): an aggregate joined back
    # (map-side partial maxima), not a window over the raw rows of a possibly hot node
    caps = materialized(t.groupBy("node_id", "source_type").agg(F.max("mw").alias("cap")), "capacities")
    smap = F.create_map(*[x for k, v in SOURCE_OF.items() for x in (F.lit(k), F.lit(v))])
    t = t.join(caps, ["node_id", "source_type"]).select(
        "msg_offset", "node_id", F.element_at(smap, F.col("source_type")).alias("source"), "mw",
        F.hour("ts").alias("h"), _climate_col(F.col("node_id")).alias("climate"), "cap")
    e = t.withColumn("curve", F.col("cap") * C.source_curve(F.col("source"), F.col("h"), F.col("climate")))
    b = e.select("msg_offset", "node_id", "source", "mw",
                 dround("curve", 4).alias("expected"),
                 dround(F.col("curve") * C.band_factor(F.col("source"), 0), 4).alias("band_lo"),
                 dround(F.col("curve") * C.band_factor(F.col("source"), 1), 4).alias("band_hi"))
    return b.withColumn("in_band", F.col("mw").between(F.col("band_lo"), F.col("band_hi")))


def _demand_curve_sql(h, base):
    m = f"exp({num(-0.5)} * pow(({h} - 9) / {num(2.0)}, 2)) * {num(0.3)}"
    e = f"exp({num(-0.5)} * pow(({h} - 20) / {num(2.5)}, 2)) * {num(0.5)}"
    load = f"{base} * ({num(0.58)} + {m} + {e}) * ({num(1.4)} / {num(1.4)})"
    spike = (f"CASE WHEN ({h} >= 18 OR {h} <= 2) THEN (CASE WHEN {h} >= 18 THEN {num(1.15)} "
             f"ELSE {num(1.15)} * {num(0.8)} END) ELSE {num(1.0)} END")
    return f"({load}) * {spike}"


@register("expected_demand_band", with_views("telemetry", extra=f"""
hn AS (SELECT node_id, {sql_hour('ts')} AS hour, {xs('mw', 4)} / COUNT(mw) AS mw FROM telemetry GROUP BY 1, 2),
t AS (SELECT node_id, hour, mw, CAST(hour(hour) AS INTEGER) AS h,
             CAST(SUM(CAST(mw AS DECIMAL(28,8))) OVER (PARTITION BY node_id) AS DOUBLE)
               / COUNT(mw) OVER (PARTITION BY node_id) AS base FROM hn),
e AS (SELECT *, {_demand_curve_sql('h', 'base')} AS curve FROM t)""") + f"""
SELECT node_id, hour, mw, {sround('curve', 4)} AS expected, {sround(f'curve * {num(0.9)}', 4)} AS band_lo,
       {sround(f'curve * {num(1.1)}', 4)} AS band_hi,
       mw BETWEEN {sround(f'curve * {num(0.9)}', 4)} AND {sround(f'curve * {num(1.1)}', 4)} AS in_band
FROM e""", "P20 B10 V14")
def expected_demand_band(spark, sf):
    t = T.telemetry(spark, sf)
    hn = t.groupBy("node_id", hour_ts("ts").alias("hour")).agg(
        (exact_sum("mw", 4) / F.count("mw")).alias("mw"))
    hn = materialized(hn, "node_hours")
    base = hn.groupBy("node_id").agg((F.sum(F.col("mw").cast("decimal(28,8)")).cast("double") / F.count("mw")).alias("base"))
    e = hn.join(materialized(base, "node_base"), "node_id").withColumn("h", F.hour("hour"))
    curve = C.demand_curve(F.col("h"), F.col("base"), F.lit(1.4), evening_spike=F.lit(1.15))
    e = e.withColumn("curve", curve)
    lo, hi = C.BANDS["demand"]
    return e.select("node_id", "hour", "mw", dround("curve", 4).alias("expected"),
                    dround(F.col("curve") * F.lit(lo), 4).alias("band_lo"),
                    dround(F.col("curve") * F.lit(hi), 4).alias("band_hi")).withColumn(
        "in_band", F.col("mw").between(F.col("band_lo"), F.col("band_hi")))


@register("climate_factor", with_views("telemetry", extra=f"""
n AS (SELECT node_id, COUNT(*) AS samples FROM telemetry GROUP BY 1),
c AS (SELECT node_id, samples, {_CLIMATE_SQL} AS climate FROM n)""") + f"""
SELECT node_id, samples, climate, {_case('climate', C.CLIMATE_SOLAR, C.SOLAR_DEFAULT)} AS solar_factor,
       {_case('climate', C.CLIMATE_WIND, C.WIND_DEFAULT)} AS wind_factor FROM c""", "P21")
def climate_factor(spark, sf):
    n = T.telemetry(spark, sf).groupBy("node_id").agg(F.count(F.lit(1)).alias("samples"))
    c = n.withColumn("climate", _climate_col(F.col("node_id")))
    return c.withColumns({"solar_factor": C.solar_factor(F.col("climate")),
                          "wind_factor": C.wind_factor(F.col("climate"))})


def _u_sql(key: str, salt: str, lo: str, hi: str) -> str:
    h = f"CAST(('0x' || substring(md5({key} || '|{salt}'), 1, 8)) AS BIGINT)"
    return f"({lo} + ({hi} - {lo}) * (({h} % 1000000) / {num(1000000.0)}))"


_SC_FLAGS = ", ".join(
    f"CAST(COALESCE(SUM(CASE WHEN flag = '{f}' THEN CAST(mwh AS DECIMAL(28,2)) END), 0) AS DOUBLE) AS {f}_cap"
    for f in FLAGS)

# The mapping table of the binding, one row for each of the 25 nodes: derived id, capacities of
# the derived node by source (a missing source means 0), jitter bounds, an added source, notes.
_MAP_SQL = f"""map AS (
  SELECT node_id, 'FF-' || node_name AS ff_id, lower(node_name) AS ff_name, {_CLIMATE_SQL} AS ff_climate,
         CASE WHEN node_id % 3 <> 0 THEN {num(400.0)} + {num(10.0)} * node_id END AS "o_A_cap",
         CASE WHEN node_id % 2 = 0 THEN {num(150.0)} + {num(5.0)} * node_id END AS "o_N_cap",
         CAST(NULL AS DOUBLE) AS "o_R_cap",
         {num(0.7)} + {num(0.01)} * (node_id % 10) AS jitter_lo, {num(1.3)} - {num(0.01)} * (node_id % 10) AS jitter_hi,
         CASE WHEN node_id % 5 = 0 THEN {num(20.0)} + node_id ELSE {num(0.0)} END AS add_tidal,
         CASE WHEN node_id % 5 = 0 THEN 'tidal added' ELSE 'same sources' END AS divergence_note,
         CASE WHEN node_id % 4 = 0 THEN 'evening peak' ELSE '' END AS demand_traits
  FROM nodes)"""


def scenario_mapping(spark, sf):
    n = F.col("node_id")
    over = F.map_filter(F.create_map(
        F.lit("A_cap"), F.when(n % 3 != 0, F.lit(400.0) + F.lit(10.0) * n),
        F.lit("N_cap"), F.when(n % 2 == 0, F.lit(150.0) + F.lit(5.0) * n)), lambda k, v: v.isNotNull())
    return T.nodes(spark, sf).select(
        "node_id", F.concat(F.lit("FF-"), "node_name").alias("ff_id"), F.lower("node_name").alias("ff_name"),
        _climate_col(n).alias("ff_climate"), over.alias("overrides"),
        (F.lit(0.7) + F.lit(0.01) * (n % 10)).alias("jitter_lo"), (F.lit(1.3) - F.lit(0.01) * (n % 10)).alias("jitter_hi"),
        F.when(n % 5 == 0, F.lit(20.0) + n).otherwise(F.lit(0.0)).alias("add_tidal"),
        F.when(n % 5 == 0, "tidal added").otherwise("same sources").alias("divergence_note"),
        F.when(n % 4 == 0, "evening peak").otherwise("").alias("demand_traits"))


def _ff_cap_sql(c: str) -> str:
    return f"CAST({sround(f'COALESCE(o_{c}, {num(0.0)}) * ' + _u_sql('ff_id', c, 'jitter_lo', 'jitter_hi'), 0)} AS BIGINT) AS ff_{c}"


SCENARIO_SQL = with_views("generation", "plants", "demand", extra=f"""
gw AS (SELECT node_id, {_SC_FLAGS} FROM generation g JOIN plants p USING (plant_id) GROUP BY 1),
dd AS (SELECT node_id, {day_of('ts')} AS day, {xs('demand_mw', 6)} AS demand_mwh FROM demand GROUP BY 1, 2),
dm AS (SELECT node_id, CAST(SUM(CAST(demand_mwh AS DECIMAL(38,6))) AS DOUBLE) / COUNT(*) AS base_demand,
              MAX(demand_mwh) AS mx FROM dd GROUP BY 1),
b AS (SELECT gw.*, base_demand, mx / base_demand AS peak_mult FROM gw JOIN dm USING (node_id)),
{_MAP_SQL},
s AS (SELECT b.*, map.* EXCLUDE (node_id), {', '.join(_ff_cap_sql(f'{f}_cap') for f in FLAGS)},
       CAST({sround('add_tidal * ' + _u_sql('ff_id', 'tidal', num(0.8), num(1.2)), 0)} AS BIGINT) AS ff_tidal,
       CAST({sround('base_demand * ' + _u_sql('ff_id', 'demand', num(0.85), num(1.15)), 0)} AS BIGINT) AS ff_demand,
       {sround('peak_mult * ' + _u_sql('ff_id', 'peak', num(0.9), num(1.1)), 2)} AS ff_peak_mult
FROM b JOIN map USING (node_id))""")
_SC_COLS = ["node_id", "ff_id", "A_cap", "N_cap", "R_cap", "base_demand", "peak_mult", "ff_A_cap", "ff_N_cap", "ff_R_cap",
            "ff_tidal", "ff_demand", "ff_peak_mult"]


@register("derive_scenario", SCENARIO_SQL + f" SELECT {', '.join(_SC_COLS)} FROM s", "P23 B11")
def derive_scenario(spark, sf):
    """Derived (second) node set from a mapping table of per-node overrides and jitter bounds."""
    return scenario(spark, sf).select(*_SC_COLS)


def scenario(spark, sf):
    return D.derive_scenario(_scenario_base(spark, sf), scenario_mapping(spark, sf), "node_id", ["A_cap", "N_cap", "R_cap"])


def _scenario_base(spark, sf):
    g = T.generation(spark, sf).select("plant_id", "flag", F.col("mwh").cast("decimal(28,2)").alias("mwh"))
    caps = (g.join(T.plants(spark, sf).select("plant_id", "node_id"), "plant_id")
            .groupBy("node_id").pivot("flag", FLAGS).agg(F.sum("mwh")))
    caps = caps.select("node_id", *[F.coalesce(F.col(f), F.lit(0)).cast("double").alias(f"{f}_cap") for f in FLAGS])
    dd = gold.node_day_demand(T.demand(spark, sf))
    dem = dd.groupBy("node_id").agg((exact_sum("demand_mwh", 6) / F.count(F.lit(1))).alias("base_demand"),
                                    F.max("demand_mwh").alias("_mx"))
    dem = dem.withColumn("peak_mult", F.col("_mx") / F.col("base_demand")).drop("_mx")
    return caps.join(dem, "node_id")


@register("anonymize", with_views("plants") + f"""
SELECT sha256('{SALT}' || CAST(plant_id AS VARCHAR)) AS plant_id, substring(plant_name, 1, 3) || '***' AS plant_name,
       node_id, round(capacity_mw, -2) AS capacity_mw
FROM plants""", "P24")
def anonymize(spark, sf):
    p = T.plants(spark, sf).select("plant_id", "plant_name", "node_id", "capacity_mw")
    return D.anonymize(p, "plant_id", SALT, "plant_name", {"capacity_mw": -2})


@register("explode_nested", """
SELECT o_orderkey AS story_id, o_orderpriority AS sprint, l_linenumber AS task_no,
       l_returnflag || ', ,' || l_linestatus AS owner,
       COALESCE(CASE WHEN l_linestatus = 'O' THEN 'in_progress' END, 'backlog') AS state,
       l_quantity AS points,
       list_filter(list_transform(string_split(l_returnflag || ', ,' || l_linestatus, ','), lambda x: trim(x)),
                   lambda x: x <> '') AS labels
FROM orders JOIN lineitem ON l_orderkey = o_orderkey""", "P25")
def explode_nested(spark, sf):
    stories = _stories(spark, sf)
    return D.explode_nested(stories, "tasks", "owner", "state", "backlog")


def _stories(spark, sf):
    """Nested input: one row per order with its lines as an array of task structs.  The array is the
    shape of the input that P25 takes apart; an order with more than a thousand lines has several rows."""
    o = T.scan(spark, sf, "orders").select(F.col("o_orderkey").alias("story_id"),
                                             F.col("o_orderpriority").alias("sprint"))
    li = T.scan(spark, sf, "lineitem")
    task = F.struct(F.col("l_linenumber").alias("task_no"),
                    F.concat(F.col("l_returnflag"), F.lit(", ,"), F.col("l_linestatus")).alias("owner"),
                    F.when(F.col("l_linestatus") == "O", F.lit("in_progress")).alias("state"),
                    F.col("l_quantity").alias("points"))
    part = F.floor(F.col("l_linenumber") / 1000)          # line numbers are dense
    t = li.groupBy(F.col("l_orderkey").alias("story_id"), part.alias("_part")).agg(F.collect_list(task).alias("tasks")).drop("_part")
    return o.join(t, "story_id")


# Node latitude of the binding: -18 - (node_id mod 38) degrees (a band from -18 to -55).
def _lat_col(node_id):
    return F.lit(-18.0) - F.pmod(node_id, F.lit(38)).cast("double")


def _season_sql(m):
    return f"CASE WHEN {m} IN (12, 1, 2) THEN 'summer' WHEN {m} IN (6, 7, 8) THEN 'winter' ELSE 'other' END"


@register("seasonal_adjustment", with_views("telemetry", extra=f"""
s AS (SELECT msg_offset, node_id, {_season_sql('month(ts)')} AS season,
             {num(-18.0)} - CAST(node_id % 38 AS DOUBLE) AS lat FROM telemetry)""") + f"""
SELECT msg_offset, node_id, season, lat,
       {_case('season', C.SOLAR_SEASON_EFF, C.SOLAR_SEASON_EFF['other'])} AS solar_eff,
       {_case('season', C.SOLAR_SEASON_PEAK, C.SOLAR_SEASON_PEAK['other'])} AS solar_peak_hour,
       {_case('season', C.WIND_SEASON, C.WIND_SEASON['other'])} *
         CASE WHEN abs(lat) > 35 THEN {num(1.25)} WHEN abs(lat) > 30 THEN {num(1.0)} ELSE {num(0.75)} END AS wind_factor,
       {_case('season', C.HYDRO_SEASON, C.HYDRO_SEASON['other'])} AS hydro_factor,
       {_case('season', C.DEMAND_SEASON, C.DEMAND_SEASON['other'])} AS demand_factor
FROM s""", "P22")
def seasonal_adjustment(spark, sf):
    t = T.telemetry(spark, sf)
    s = t.select("msg_offset", "node_id", C.southern_season(F.month("ts")).alias("season"),
                 _lat_col(F.col("node_id")).alias("lat"))
    sc = F.col("season")
    return s.select("msg_offset", "node_id", "season", "lat",
                    C.season_factor(C.SOLAR_SEASON_EFF, sc).alias("solar_eff"),
                    C.season_factor(C.SOLAR_SEASON_PEAK, sc).alias("solar_peak_hour"),
                    (C.season_factor(C.WIND_SEASON, sc) * C.wind_latitude_factor(F.col("lat"))).alias("wind_factor"),
                    C.season_factor(C.HYDRO_SEASON, sc).alias("hydro_factor"),
                    C.season_factor(C.DEMAND_SEASON, sc).alias("demand_factor"))
