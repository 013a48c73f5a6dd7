"""Dictionary lookups: fixed dicts as map literals, mapping tables as broadcast joins.

A fixed dictionary (tens of entries) becomes a ``map`` literal: the lookup is
a codegen'd hash probe inside the projection, no join operator at all. A
mapping *table* (e.g. an id -> label file) is joined with a broadcast hint;
its size is bounded by the code domain, not by the data.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def map_literal(mapping: Mapping) -> Column:
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv)


def lookup(key, mapping: Mapping, default=None) -> Column:
    """``mapping[key]``; unmatched (or null key) -> ``default`` (null if None)."""
    k = F.col(key) if isinstance(key, str) else key
    v = F.when(k.isNotNull(), F.try_element_at(map_literal(mapping), k))
    return v if default is None else F.coalesce(v, F.lit(default))


def lookup_int_label(raw, mapping: Mapping[int, str]) -> Column:
    """Parse ``raw`` text as int, look up its label, else echo the raw text."""
    r = F.col(raw) if isinstance(raw, str) else raw
    txt = F.coalesce(F.trim(r.cast("string")), F.lit("unknown"))
    as_int = F.when(txt.rlike(r"^[+-]?\d+$"), txt.try_cast("int"))
    return F.coalesce(lookup(as_int, mapping), txt)


def dimension(spark, mapping: Mapping, key: str, value: str, key_type: str = "int") -> DataFrame:
    return spark.createDataFrame(list(mapping.items()), f"{key} {key_type}, {value} string")


def decode_with(df: DataFrame, dim: DataFrame, on: str, label: str, out: str,
                dim_key: str = "k") -> DataFrame:
    """Left join a mapping table; Spark broadcasts it where its size allows."""
    d = dim.select(F.col(dim_key).alias("_dk"), F.col(label).alias(out))
    return df.join(d, df[on] == d["_dk"], "left").drop("_dk")
