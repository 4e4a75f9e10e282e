"""Query registry: name -> (Spark callable, DuckDB oracle SQL or None).

A callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame.  Queries whose meaning has no
SQL form (iterative or stateful streaming work) register ``sql=None`` and get a rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
IDS: dict[str, str] = {}


def bigint_counts(sql: str) -> str:
    """DuckDB types COUNT_IF as HUGEINT; Spark's count_if is BIGINT.  Wrap each COUNT_IF(...) of
    our oracle text in a BIGINT cast so the two result schemas agree."""
    out, i, key = [], 0, "COUNT_IF("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len(key) - 1
        while True:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            if depth == 0:
                break
            k += 1
        out.append(sql[i:j] + "CAST(" + sql[j:k + 1] + " AS BIGINT)")
        i = k + 1


def register(name: str, sql: str | None, ids: str = "") -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        IDS[name] = ids
        if sql is not None:
            ORACLE[name] = bigint_counts(sql)
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so their ``register`` calls run."""
    from wattline.plans import (  # noqa: F401
        bronze_plans, derive_plans, dims_plans, gold_plans, join_plans, ops_plans,
        quality_plans, silver_plans, sketch_plans, stream_plans, layout_plans,
    )
