"""DuckDB definitions of the energy views of ``sources.tables``, used by the oracle SQL.

Each constant is a CTE body; ``with_views`` prefixes a query with the ones it names.
"""

from __future__ import annotations

VIEWS = {
    "telemetry": """telemetry AS (
  SELECT ts, user_id AS node_id, event_type AS source_type, value AS mw, props AS raw,
         event_id AS msg_offset
  FROM events)""",
    "generation": """generation AS (
  SELECT l_orderkey AS gen_order, l_linenumber AS gen_line, l_suppkey AS plant_id, l_partkey AS asset_id,
         l_shipdate AS ts, l_quantity AS mwh, l_extendedprice AS revenue,
         l_quantity * l_discount AS curtailed, l_discount AS curtail_rate, l_tax AS spot_adj,
         l_linestatus AS status, l_returnflag AS flag
  FROM lineitem)""",
    "nodes": """nodes AS (
  SELECT n_nationkey AS node_id, n_name AS node_name, r_name AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey)""",
    "plants": """plants AS (
  SELECT s_suppkey AS plant_id, s_name AS plant_name, node_id, node_name, region,
         greatest(abs(s_acctbal), 1.0) AS capacity_mw, s_acctbal AS acctbal
  FROM supplier JOIN nodes ON s_nationkey = node_id)""",
    "demand": """demand AS (
  SELECT o_orderkey AS reading_id, c_nationkey AS node_id, o_orderdate AS ts,
         o_totalprice / 1000 AS demand_mw, c_mktsegment AS dataset, o_orderstatus AS status
  FROM orders JOIN customer ON o_custkey = c_custkey)""",
    "assets": """assets AS (
  SELECT p_partkey AS asset_id, p_name AS asset_name, p_brand AS make, p_type AS model,
         p_size AS size_class, p_retailprice AS list_price
  FROM part)""",
}

_DEPS = {"plants": ["nodes"]}


def with_views(*names: str, extra: str = "") -> str:
    """``WITH`` clause holding the named views (dependencies first) and optional extra CTEs."""
    ordered: list[str] = []
    for n in names:
        for d in _DEPS.get(n, []) + [n]:
            if d not in ordered:
                ordered.append(d)
    parts = [VIEWS[n] for n in ordered]
    if extra:
        parts.append(extra)
    return "WITH " + ",\n".join(parts) + "\n"
