"""Distributed rank and prefix sums without a single-partition window.

``Window.orderBy`` without ``partitionBy`` (or partitioned by a 2-valued
label) funnels the data through one task. Every ordered computation here is
two-level instead:

1. derive a *monotone bucket* from the order key: top bits of a keyed hash, or
   for any number the quantile range it falls into (``QUANTILES`` cut points of one
   mergeable sketch over all rows), cut again into ``PARTS`` even parts;
2. sum per (group, bucket), combined map-side: at most groups x buckets rows
   cross the network;
3. exclusive prefix over the buckets in that small table (one task per group,
   bounded by the buckets, not by the data);
4. join the offsets back and finish with a window partitioned by (group, bucket).

The sketch only says where to cut: ranks and sums are exact whatever it says. Groups
are compared as one struct, so null groups join by plain equality, and the
window uses the join's partitioning: each row crosses the network once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.hashing import HASH_BITS

QUANTILES, PARTS, ACCURACY = 256, 64, 4096
_STEP = 16  # cut points of a first search


def hash_rank(df: DataFrame, by: Sequence[str], hash_col: str, tiebreak: Sequence[str],
              *, bucket_bits: int = 16, rank_col: str = "_rank", size_col: str = "_n") -> DataFrame:
    """1-based rank within ``by`` ordered by (hash, tiebreak..), plus stratum size.

    The hash is uniform on [0, 2**32), so its top ``bucket_bits`` bits give
    balanced buckets with no sampling pass.
    """
    x = df.withColumn("_by", F.struct(*by, F.lit(0).alias("_0"))).withColumn("_hb", F.shiftright(F.col(hash_col), HASH_BITS - bucket_bits))
    counts = x.groupBy("_by", "_hb").agg(F.count(F.lit(1)).alias("_bc"))
    below = Window.partitionBy("_by").orderBy("_hb").rowsBetween(Window.unboundedPreceding, 0)
    offsets = counts.select("_by", "_hb", (F.sum("_bc").over(below) - F.col("_bc")).alias("_off"),
                            F.sum("_bc").over(Window.partitionBy("_by")).alias(size_col))
    w = Window.partitionBy("_by", "_hb").orderBy(F.col(hash_col), *[F.col(t) for t in tiebreak])
    return (x.join(offsets, ["_by", "_hb"]).withColumn(rank_col, F.col("_off") + F.row_number().over(w))
             .select(*df.columns, rank_col, size_col))


def with_range_bucket(df: DataFrame, c: str, out: str) -> DataFrame:
    """``df`` with a bucket that never decreases as the number ``c`` increases, about as many rows in each.

    The cut points are a scalar subquery: one row of ``QUANTILES + 1`` numbers. Between two
    of them the range is cut evenly. Only nulls and NaN have no place and go last.
    """
    x = F.col(c).cast("double")
    shares = F.array(*[F.lit(i / QUANTILES) for i in range(QUANTILES + 1)])
    points = df.agg(F.percentile_approx(F.when(~F.isnan(x), x), shares, F.lit(ACCURACY)).alias("_rb_cuts")).scalar()
    cuts = F.col("_rb_cuts")  # a column, as a lambda may not hold a subquery
    some = F.array(*[F.try_element_at(cuts, F.lit(i)) for i in range(_STEP, QUANTILES, _STEP)])
    coarse = F.size(F.filter(some, lambda p: p <= x)) * _STEP
    q = F.col("_rb_q")
    low, high = F.try_element_at(cuts, q), F.try_element_at(cuts, q + 1)
    part = F.floor(F.try_divide(x - low, high - low) * PARTS)
    inside = F.when((q >= 1) & (high > low) & (high - low < float("inf")), F.greatest(F.lit(0), F.least(part, F.lit(PARTS - 1)))).otherwise(0)
    bucket = F.when(x.isNull() | F.isnan(x), F.lit((QUANTILES + 2) * PARTS)).otherwise(q * PARTS + F.coalesce(inside, F.lit(0)))
    found = df.withColumn("_rb_cuts", F.coalesce(points, F.array(F.lit(0.0)))).withColumn("_rb_c", coarse)
    found = found.withColumn("_rb_q", F.col("_rb_c") + F.size(F.filter(F.slice(cuts, F.col("_rb_c") + 1, _STEP), lambda p: p <= x)))
    return found.withColumn(out, bucket.cast("long")).drop("_rb_cuts", "_rb_c", "_rb_q")


def prefix_sums(df: DataFrame, by: Sequence[str], order_col: str, value_cols: Sequence[str]) -> DataFrame:
    """For rows unique in (by, order_col): sums of ``value_cols`` over rows with a
    smaller order key (``<v>_below``) and over the whole group (``<v>_total``)."""
    x = with_range_bucket(df, order_col, "_qb").withColumn("_by", F.struct(*by, F.lit(0).alias("_0")))
    totals = x.groupBy("_by", "_qb").agg(*[F.sum(v).alias(f"_bt_{v}") for v in value_cols])
    below = Window.partitionBy("_by").orderBy("_qb").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("_by")
    offsets = totals.select("_by", "_qb", *[(F.sum(f"_bt_{v}").over(below) - F.col(f"_bt_{v}")).alias(f"_off_{v}") for v in value_cols],
                            *[F.sum(f"_bt_{v}").over(whole).alias(f"{v}_total") for v in value_cols])
    inside = Window.partitionBy("_by", "_qb").orderBy(F.col(order_col)).rowsBetween(Window.unboundedPreceding, -1)
    return x.join(offsets, ["_by", "_qb"]).select(
        *df.columns, *[(F.col(f"_off_{v}") + F.coalesce(F.sum(v).over(inside), F.lit(0))).alias(f"{v}_below") for v in value_cols],
        *[f"{v}_total" for v in value_cols])


def order_rank(df: DataFrame, by: Sequence[str], order_col: str, *, rank_col: str = "_rank",
               size_col: str = "_n") -> DataFrame:
    """1-based rank by a unique order key within ``by``, distributed."""
    out = prefix_sums(df.withColumn("_one", F.lit(1).cast("long")), by, order_col, ["_one"])
    return (out.withColumn(rank_col, F.col("_one_below") + 1)
               .withColumnRenamed("_one_total", size_col)
               .drop("_one", "_one_below"))
