"""Registry of catalogued queries and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``sql`` is the equivalent DuckDB text over the driver views; omit it only
    for operators with no SQL equivalent (they get a rows-only check).
    """
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(expr: str) -> str:
    """DuckDB rounding twin of ``riskloom.functions.stats.r6``."""
    return f"(round(({expr}), 6) + 0.0e0)"
