"""Closed-form statistics as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.functions.vocab import Z95


def one_row(agg) -> Column:
    """A one-row aggregate as a struct-valued scalar subquery (evaluated once,
    no join): fields are read with ``one_row(agg)["name"]``."""
    return agg.select(F.struct(*agg.columns).alias("v")).scalar()


def r6(c) -> Column:
    """Round to 6 d.p. and fold -0.0 into 0.0 (engine-independent doubles)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), 6) + F.lit(0.0)


def wilson_bounds(k, n, z: float = Z95) -> tuple[Column, Column]:
    """Wilson score interval for k successes in n trials."""
    k = F.col(k) if isinstance(k, str) else k
    n = F.col(n) if isinstance(n, str) else n
    n = n.cast("double")
    p = k / n
    z2 = z * z
    denom = 1.0 + z2 / n
    centre = (p + z2 / (2.0 * n)) / denom
    half = F.lit(z) * F.sqrt(p * (1.0 - p) / n + z2 / (4.0 * n * n)) / denom
    return centre - half, centre + half


def sql_wilson(k: str, n: str, z: float = Z95) -> tuple[str, str]:
    """DuckDB text of :func:`wilson_bounds`."""
    p = f"({k} * 1.0e0 / {n})"
    nn = f"({n} * 1.0e0)"
    z2 = repr(z * z)
    denom = f"(1.0e0 + {z2} / {nn})"
    centre = f"(({p} + {z2} / (2.0e0 * {nn})) / {denom})"
    half = f"({z!r} * sqrt({p} * (1.0e0 - {p}) / {nn} + {z2} / (4.0e0 * {nn} * {nn})) / {denom})"
    return f"{centre} - {half}", f"{centre} + {half}"
