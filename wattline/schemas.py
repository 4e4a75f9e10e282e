"""Declared schemas (S13) and data-quality thresholds.

Bronze tables carry the lineage columns ``META``; every series table also gets ``event_date`` for
partitioning by day (the declared layout partitions by the date of the timestamp).
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, I, L, TS, DT = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.TimestampType(), T.DateType()


def _f(name, t, nullable=True):
    return T.StructField(name, t, nullable)


META = [_f("_loaded_at", TS, False), _f("_source", S, False), _f("_batch_id", S, False),
        _f("_kafka_partition", I), _f("_kafka_offset", L), _f("_dataset", S, False)]
PLANT_META = [_f("_loaded_at", TS, False), _f("_source", S, False), _f("_batch_id", S, False),
              _f("_dataset", S, False)]

# Bronze column lists per table, in declared order.
BRONZE_COLUMNS = {
    "scada_telemetry": [("timestamp", TS, False), ("node_id", S, False), ("solar_mw", D, True),
                        ("wind_mw", D, True), ("hydro_mw", D, True), ("geothermal_mw", D, True),
                        ("tidal_mw", D, True), ("total_generation_mw", D, True)],
    "weather": [("timestamp", TS, False), ("node_id", S, False), ("climate", S, True),
                ("solar_irradiance_wm2", D, True), ("wind_speed_ms", D, True), ("temperature_c", D, True),
                ("humidity_pct", D, True)],
    "demand": [("timestamp", TS, False), ("node_id", S, False), ("demand_mw", D, False),
               ("residential_pct", D, True), ("industrial_pct", D, True), ("commercial_pct", D, True)],
    "grid_dispatch": [("timestamp", TS, False), ("node_id", S, False), ("total_generation_mw", D, True),
                      ("total_demand_mw", D, True), ("balance_mw", D, True), ("curtailment_mw", D, True),
                      ("spot_price", D, True), ("ppa_price", D, True), ("revenue", D, True),
                      ("curtailment_cost", D, True), ("carbon_offset_tco2e", D, True)],
    "plants": [("plant_id", S, False), ("node_id", S, False), ("node_name", S, True), ("region", S, True),
               ("source_type", S, False), ("capacity_mw", D, False), ("climate", S, True),
               ("ppa_price_mwh", D, True), ("lat", D, True), ("lon", D, True), ("cen_barra", S, True)],
}

# Topic -> Bronze table routing.
TOPIC_TABLE = {
    "energy.bronze.scada": "scada_telemetry",
    "energy.bronze.weather": "weather",
    "energy.bronze.demand": "demand",
    "energy.bronze.dispatch": "grid_dispatch",
    "energy.bronze.plants": "plants",
}


def bronze_schema(table: str) -> T.StructType:
    fields = [_f(n, t, nl) for n, t, nl in BRONZE_COLUMNS[table]]
    if table == "plants":
        return T.StructType(fields + PLANT_META)
    return T.StructType(fields + META + [_f("event_date", DT, True)])


def string_schema(table: str) -> T.StructType:
    """All-STRING parse schema of a topic's JSON payload (numbers arrive quoted), plus _dataset."""
    return T.StructType([_f(n, S) for n, _, _ in BRONZE_COLUMNS[table]] + [_f("_dataset", S)])


DLQ_SCHEMA = T.StructType([_f("received_at", TS, False), _f("topic", S, False), _f("partition_id", I),
                           _f("offset_id", L), _f("key", S), _f("value", S), _f("error_message", S),
                           _f("_batch_id", S, False)])

MESSAGE_SCHEMA = T.StructType([_f("key", T.BinaryType()), _f("value", T.BinaryType()), _f("topic", S),
                               _f("partition", I), _f("offset", L), _f("timestamp", TS)])

# Data-quality limits per environment (null %, duplicate %, freshness hours) and
# whether a warning fails the run.
THRESHOLDS = [
    ("dev", "null_pct", 5.0), ("qa", "null_pct", 2.0), ("prd", "null_pct", 0.1),
    ("dev", "duplicate_pct", 1.0), ("qa", "duplicate_pct", 0.5), ("prd", "duplicate_pct", 0.1),
    ("dev", "freshness_hours", 168.0), ("qa", "freshness_hours", 48.0), ("prd", "freshness_hours", 2.0),
]
FAIL_ON_WARN = {"dev": False, "qa": False, "prd": True}
MIN_ROWS = 100

# Declared column types of the driver's tables (family names), for the schema check (V1).  Those of nation
# and customer are declared as an older version had them, so that the check has something to find.
DRIVER_TYPES = {
    "events": {"event_id": "bigint", "ts": "timestamp", "user_id": "bigint", "event_type": "string",
               "value": "double", "props": "string"},
    "lineitem": {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
                 "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
                 "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp"},
    "orders": {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
               "o_totalprice": "double", "o_orderdate": "timestamp", "o_orderpriority": "string"},
    "region": {"r_regionkey": "int", "r_name": "string"},
    "nation": {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int", "n_comment": "string"},
    "customer": {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "bigint", "c_acctbal": "double"},
    "part": {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int",
             "p_retailprice": "double"},
    "supplier": {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double",
                 "s_region": "string"},
}


def type_family(t: T.DataType) -> str:
    return {T.LongType: "bigint", T.IntegerType: "int", T.DoubleType: "double", T.StringType: "string",
            T.TimestampNTZType: "timestamp", T.TimestampType: "timestamp", T.DateType: "date"}.get(
        type(t), t.simpleString())
