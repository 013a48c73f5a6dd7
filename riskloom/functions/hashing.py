"""Keyed hashing: the only source of randomness in the package.

A row's draw depends on (key, seed, purpose) only — never on partitioning,
task order or retries — so every split, fold, sample and bootstrap weight is
replayable after executor loss and reproducible by the SQL oracle:

    Spark : conv(substr(md5(concat_ws('|', key.., seed, purpose)), 1, 8), 16, 10)
    DuckDB: ('0x' || substr(md5(concat_ws('|', key.., seed, purpose)), 1, 8))::BIGINT
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 32


def keyed_hash(*keys, seed: int = 42, purpose: str = "") -> Column:
    """Unsigned 32-bit hash of ``keys`` as bigint in [0, 2**32)."""
    parts = [F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in keys]
    parts += [F.lit(str(seed)), F.lit(purpose)]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("bigint")


def keyed_uniform(*keys, seed: int = 42, purpose: str = "") -> Column:
    """Uniform [0, 1) draw from the keyed hash."""
    return keyed_hash(*keys, seed=seed, purpose=purpose) / F.lit(float(2 ** HASH_BITS))


def sql_keyed_hash(keys: list[str], seed: int = 42, purpose: str = "") -> str:
    """DuckDB text of :func:`keyed_hash` (for oracle SQL)."""
    inner = ", ".join([f"cast({k} as varchar)" for k in keys] + [f"'{seed}'", f"'{purpose}'"])
    return f"('0x' || substr(md5(concat_ws('|', {inner})), 1, 8))::BIGINT"
