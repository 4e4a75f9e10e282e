"""Small SQL text helpers for the DuckDB oracle strings (mirror of ``functions.columns``)."""

from __future__ import annotations


def xs(expr: str, scale: int) -> str:
    """Exact sum through DECIMAL, returned as DOUBLE (same as ``columns.exact_sum``)."""
    return f"CAST(SUM(CAST({expr} AS DECIMAL(28,{scale}))) AS DOUBLE)"


def num(v: float) -> str:
    """A DOUBLE literal with the exact value Python holds (DuckDB reads ``1.5`` as DECIMAL)."""
    return f"CAST({v!r} AS DOUBLE)"


def ratio(a: str, b: str) -> str:
    return f"(({a}) / NULLIF(({b}), 0))"


def hour_of(ts: str) -> str:
    return f"CAST(hour({ts}) AS INTEGER)"


def day_of(ts: str) -> str:
    return f"CAST({ts} AS DATE)"


def month_of(ts: str) -> str:
    return f"CAST(date_trunc('month', {ts}) AS DATE)"


def hour_ts(ts: str) -> str:
    return f"CAST(date_trunc('hour', {ts}) AS TIMESTAMP)"


def dround(expr: str, scale: int) -> str:
    """Mirror of ``columns.dround``."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,9)), {scale}) AS DOUBLE)"
