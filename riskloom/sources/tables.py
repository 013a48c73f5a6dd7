"""Parquet table scans.

Scans are lazy: Catalyst prunes columns and pushes filters into the parquet
reader, so callers select only what they need.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def register_tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """Register driver tables as temp views (same names the SQL oracle sees)."""
    out = {}
    for n in names or DRIVER_TABLES:
        df = read_table(spark, sf_dir, n)
        df.createOrReplaceTempView(n)
        out[n] = df
    return out
