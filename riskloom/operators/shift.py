"""Distribution-shift statistics between two strata.

SMD per feature = (mean_b - mean_a) / std_all, with std_all the sample
standard deviation over *both* strata (zero -> null). Features come in long
form ``(row_id, feature, value)``; absent entries are zeros (sparse one-hot),
so everything is expressed through per-feature sums, sums of squares and the
stratum sizes — one partial aggregation, no densification.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.stats import r6


def unpivot(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Dense columns -> long ``(key, feature, value)`` (nulls dropped, like pandas mean/std)."""
    st = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
                             for c in cols]))
    return df.select(key, st.alias("s")).select(key, "s.feature", "s.value").where(F.col("value").isNotNull())


def smd_sparse(long: DataFrame, groups: DataFrame, key: str, group_col: str, a: str, b: str,
               dense: Sequence[str] = ()) -> DataFrame:
    """(feature, mean_a, mean_b, std_all, smd, abs_diff) for stratum values a -> b.

    ``groups`` has one row per key with its stratum; rows missing in ``long``
    for a feature count as 0, but are skipped for the ``dense`` (numeric) ones.
    """
    from riskloom.functions.stats import one_row
    sizes = one_row(groups.agg(F.sum((F.col(group_col) == a).cast("long")).alias("na"),
                               F.sum((F.col(group_col) == b).cast("long")).alias("nb")))
    j = long.join(groups.select(key, group_col), key)
    is_a = F.col(group_col) == a
    is_b = F.col(group_col) == b
    agg = j.groupBy("feature").agg(
        F.sum(F.when(is_a, F.col("value")).otherwise(0.0)).alias("_sa"),
        F.sum(F.when(is_b, F.col("value")).otherwise(0.0)).alias("_sb"),
        F.sum(F.when(is_a | is_b, F.col("value") * F.col("value")).otherwise(0.0)).alias("_ss"),
        F.count(F.when(is_a, F.col("value"))).alias("_ca"),
        F.count(F.when(is_b, F.col("value"))).alias("_cb"),
        F.stddev_samp(F.when(is_a | is_b, F.col("value"))).alias("_sd"))
    numeric = F.col("feature").isin(*dense)
    x = (agg.withColumn("_na", F.nullif(F.when(numeric, F.col("_ca")).otherwise(sizes["na"]), F.lit(0)))
            .withColumn("_nb", F.nullif(F.when(numeric, F.col("_cb")).otherwise(sizes["nb"]), F.lit(0))))
    n = F.col("_na") + F.col("_nb")
    ma = F.col("_sa") / F.col("_na")
    mb = F.col("_sb") / F.col("_nb")
    tot = F.col("_sa") + F.col("_sb")
    var = (F.col("_ss") - tot * tot / n) / F.nullif(n - 1, F.lit(0))
    sd = F.when(numeric, F.col("_sd")).otherwise(F.sqrt(F.greatest(var, F.lit(0.0))))
    return x.select("feature", r6(ma).alias("mean_a"), r6(mb).alias("mean_b"), r6(sd).alias("std_all"),
                    r6(F.when(sd > 1e-12, (mb - ma) / sd)).alias("smd"),
                    r6(F.abs(mb - ma)).alias("abs_diff"))


def smd_dense(df: DataFrame, cols: Sequence[str], group_col: str, a: str, b: str) -> DataFrame:
    """SMD over dense numeric columns (nulls skipped per feature)."""
    long = df.select(group_col, F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols])).alias("s"))
    long = long.select(group_col, "s.feature", "s.value").where(F.col("value").isNotNull() & F.col(group_col).isin(a, b))
    g = long.groupBy("feature").agg(
        F.avg(F.when(F.col(group_col) == a, F.col("value"))).alias("_ma"),
        F.avg(F.when(F.col(group_col) == b, F.col("value"))).alias("_mb"),
        F.stddev_samp("value").alias("_sd"))
    return g.select("feature", r6("_ma").alias("mean_a"), r6("_mb").alias("mean_b"), r6("_sd").alias("std_all"),
                    r6(F.when(F.col("_sd") > 1e-12, (F.col("_mb") - F.col("_ma")) / F.col("_sd"))).alias("smd"),
                    r6(F.abs(F.col("_mb") - F.col("_ma"))).alias("abs_diff"))


def topk_both_ends(df: DataFrame, col: str, k: int, key: str = "feature") -> DataFrame:
    """k lowest and k highest by ``col`` (nulls dropped), key as tie-break.

    Each end is a ``TakeOrderedAndProject`` (per-partition top-k, then merge),
    so only 2k rows per partition move.
    """
    x = df.where(F.col(col).isNotNull())
    lo = x.orderBy(F.col(col).asc(), F.col(key).asc()).limit(k).withColumn("end", F.lit("lowest"))
    hi = x.orderBy(F.col(col).desc(), F.col(key).asc()).limit(k).withColumn("end", F.lit("highest"))
    return lo.unionByName(hi)
