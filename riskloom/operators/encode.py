"""Target encodings and class weights.

Smoothed mean: ``(sum + g * s) / (count + s)`` with prior ``g`` (global train
mean) and weight ``s``; unseen / null categories get ``g`` — which the same
formula yields for count = 0.

Out-of-fold: one aggregation by (category, fold) gives per-fold sums; the
category totals come from a window over that small table (<= K rows per
category); a row in fold f uses ``total - own fold``. One shuffle of the data
instead of K passes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.vocab import TARGET_SMOOTHING


def _prior(train: DataFrame, label: str):
    """Global mean of the label as a scalar subquery."""
    return train.agg(F.avg(F.col(label).cast("double")).alias("_g")).scalar()


def target_mean_table(train: DataFrame, cat: str, label: str, s: float = TARGET_SMOOTHING) -> DataFrame:
    """(category, n, enc) learned on ``train``; null categories are not a level."""
    g = _prior(train, label)
    t = (train.where(F.col(cat).isNotNull()).groupBy(cat)
              .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("double")).alias("_sum")))
    return t.select(cat, "n", ((F.col("_sum") + g * s) / (F.col("n") + s)).alias("enc"), g.alias("_g"))


def target_mean_smoothed(train: DataFrame, apply_to: DataFrame, cat: str, label: str,
                         s: float = TARGET_SMOOTHING, out: str | None = None) -> DataFrame:
    """Encode ``apply_to[cat]`` with the table learned on ``train``."""
    out = out or f"{cat}_te"
    t = target_mean_table(train, cat, label, s)
    g = _prior(train, label)
    j = apply_to.join(t.select(cat, F.col("enc").alias(out)), cat, "left")
    return j.withColumn(out, F.coalesce(F.col(out), g))


def target_oof(train: DataFrame, cat: str, label: str, fold: str, s: float = TARGET_SMOOTHING,
               out: str | None = None) -> DataFrame:
    """Out-of-fold encoding of every training row (prior = mean over all of train)."""
    out = out or f"{cat}_te"
    g = _prior(train, label)
    per = (train.where(F.col(cat).isNotNull()).groupBy(cat, fold)
                .agg(F.count(F.lit(1)).alias("_cf"), F.sum(F.col(label).cast("double")).alias("_sf")))
    w = Window.partitionBy(cat)
    per = per.select(cat, fold, (F.sum("_cf").over(w) - F.col("_cf")).alias("_co"),
                     (F.sum("_sf").over(w) - F.col("_sf")).alias("_so"))
    j = train.join(per, [cat, fold], "left")
    enc = (F.coalesce(F.col("_so"), F.lit(0.0)) + g * s) / (F.coalesce(F.col("_co"), F.lit(0)) + s)
    return j.withColumn(out, enc).drop("_co", "_so")


def class_weight_ratio(train: DataFrame, label: str) -> DataFrame:
    """n_neg / max(n_pos, 1) (boosting scale_pos_weight)."""
    a = train.agg(F.sum(F.col(label).cast("long")).alias("n_pos"), F.count(F.lit(1)).alias("n"))
    return a.select("n_pos", (F.col("n") - F.col("n_pos")).alias("n_neg"),
                    ((F.col("n") - F.col("n_pos")) / F.greatest(F.col("n_pos"), F.lit(1))).alias("ratio"))


def class_weight_balanced(train: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Per-row weight n / (2 * n_class): counts per class joined back."""
    n = train.agg(F.count(F.lit(1)).alias("_n")).scalar()
    per = train.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    per = per.select(label, (n / (2.0 * F.col("_nc"))).alias(out))
    return train.join(per, label, "left")


def _long_codes(df: DataFrame, key: str, cols, extra=()) -> DataFrame:
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("var"), F.col(c).cast("string").alias("cat")) for c in cols]))
    x = df.select(key, *extra, pairs.alias("p"))
    names = [c for c in x.columns if c not in (key, "p")]
    return x.select(key, *names, "p.var", "p.cat")


def target_encode_many(train: DataFrame, apply_to: DataFrame, cols, label: str, fold: str, *,
                       key: str = "row_id", s: float = TARGET_SMOOTHING) -> DataFrame:
    """Encode several categorical columns at once, in long form.

    Training rows (``train``, with a ``fold`` column) get out-of-fold values;
    ``apply_to`` rows get values learned on all of ``train``. One unpivot, one
    aggregation by (column, category, fold), one pivot back on a known column
    list: the plan grows linearly with the number of columns.
    Output: ``key`` + ``<col>_te`` per column.
    """
    g = _prior(train, label)
    lt = _long_codes(train, key, cols, extra=(F.col(label).cast("double").alias("_y"), F.col(fold).alias("_f")))
    per = lt.where(F.col("cat").isNotNull()).groupBy("var", "cat", "_f").agg(
        F.count(F.lit(1)).alias("_cf"), F.sum("_y").alias("_sf"))
    w = Window.partitionBy("var", "cat")
    per = per.select("var", "cat", "_f", (F.sum("_cf").over(w) - F.col("_cf")).alias("_co"),
                     (F.sum("_sf").over(w) - F.col("_sf")).alias("_so"),
                     F.sum("_cf").over(w).alias("_ct"), F.sum("_sf").over(w).alias("_st"))
    full = per.select("var", "cat", "_ct", "_st").distinct()
    tr = lt.join(per.select("var", "cat", "_f", "_co", "_so"), ["var", "cat", "_f"], "left")
    tr = tr.select(key, "var", ((F.coalesce("_so", F.lit(0.0)) + g * s) /
                                (F.coalesce("_co", F.lit(0)) + s)).alias("_enc"))
    la = _long_codes(apply_to, key, cols)
    ap = la.join(full, ["var", "cat"], "left")
    ap = ap.select(key, "var", F.coalesce((F.col("_st") + g * s) / (F.col("_ct") + s), g).alias("_enc"))
    both = tr.unionByName(ap)
    wide = both.groupBy(key).pivot("var", list(cols)).agg(F.first("_enc"))
    return wide.select(key, *[F.col(c).alias(f"{c}_te") for c in cols])
