"""Outcome rates with Wilson intervals, over one or many groupings in one scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.stats import r6, wilson_bounds


def _label(label) -> Column:
    return F.col(label) if isinstance(label, str) else label


def rate_wilson(df: DataFrame, group_col: str, label, *, category_name: str = "category",
                digits_round: bool = True) -> DataFrame:
    """Per category: n, k, k/n and the Wilson 95 % interval.

    Partial aggregation happens map-side (HashAggregate before the exchange),
    so only one small row per (task, category) is shuffled. Null keys are
    dropped first (pandas ``groupby`` semantics).
    """
    y = _label(label).cast("long")
    agg = (df.where(F.col(group_col).isNotNull())
             .groupBy(F.col(group_col).alias(category_name))
             .agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("k")))
    return with_wilson(agg, digits_round=digits_round)


def with_wilson(agg: DataFrame, k: str = "k", n: str = "n", digits_round: bool = True) -> DataFrame:
    lo, hi = wilson_bounds(k, n)
    rnd = r6 if digits_round else (lambda c: c)
    return agg.select(*[c for c in agg.columns],
                      rnd(F.col(k) / F.col(n)).alias("rate"),
                      rnd(lo).alias("ci_lo"), rnd(hi).alias("ci_hi"))


def rate_wilson_sets(df: DataFrame, group_cols: Sequence[str], label) -> DataFrame:
    """Wilson rate tables for several groupings in a single aggregation.

    Equivalent to one ``GROUPING SETS ((g1), (g2), ...)``: one scan, one
    shuffle, instead of a separate job per grouping. Output is long form
    ``(variable, category, n, k, rate, ci_lo, ci_hi)``.
    """
    y = _label(label).cast("long")
    # unpivot each row into one (variable, category) row per grouping, then one agg
    pairs = F.explode(F.array(*[
        F.struct(F.lit(g).alias("variable"), F.col(g).cast("string").alias("category"))
        for g in group_cols]))
    long = df.select(pairs.alias("vc"), y.alias("_y")).select("vc.variable", "vc.category", "_y")
    agg = (long.where(F.col("category").isNotNull())
               .groupBy("variable", "category")
               .agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("k")))
    return with_wilson(agg)


def having_min_n(rates: DataFrame, min_n: int = 30, n_col: str = "n") -> DataFrame:
    return rates.where(F.col(n_col) >= min_n)


def sort_rate_desc(rates: DataFrame, rate_col: str = "rate", key: str = "category") -> DataFrame:
    """Rate descending, key as a total-order tie-break."""
    return rates.orderBy(F.col(rate_col).desc(), F.col(key).asc())


def reindex_ordered(rates: DataFrame, order: Sequence[str], key: str = "category") -> DataFrame:
    """Left-join a fixed ordered category list; absent categories become null rows.

    The ordered list is a literal of bounded size, broadcast to the join.
    """
    spark = rates.sparkSession
    dim = spark.createDataFrame([(i, v) for i, v in enumerate(order)], f"pos int, {key} string")
    return (rates.join(F.broadcast(dim), key, "right")
            .orderBy("pos").drop("pos"))
