"""Exact ranking metrics by tie groups: AUC, DeLong interval, ROC, operating points.

All metrics start from the tie table ``(group.., score, pos, neg)`` — a
map-side-combined aggregation — and use ``ranking.prefix_sums`` for the
ordered part, so no step sorts a whole group in one task.

DeLong by tie groups, for a score s with p(s) positives and n(s) negatives,
N-(s) negatives strictly below and P+(s) positives strictly above:

    a10 = (N- + n/2) / N          a01 = (P+ + p/2) / P
    AUC = sum p * a10 / P
    S10 = (sum p * a10^2 - P * AUC^2) / (P - 1)
    S01 = (sum n * a01^2 - N * AUC^2) / (N - 1)
    var = S10 / P + S01 / N ;  CI = AUC -/+ z * sqrt(var), clipped to [0, 1]
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.stats import r6
from riskloom.functions.vocab import Z95
from riskloom.operators.ranking import prefix_sums


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tie_table(df: DataFrame, group_cols: Sequence[str], score, label) -> DataFrame:
    """(group.., score, pos, neg): rows with a null score or label are dropped."""
    s = _col(score).cast("double")
    y = _col(label).cast("int")
    x = df.select(*group_cols, s.alias("score"), y.alias("_y")).where(
        F.col("score").isNotNull() & F.col("_y").isNotNull() & ~F.isnan("score"))
    return x.groupBy(*group_cols, "score").agg(
        F.sum(F.col("_y")).cast("long").alias("pos"),
        F.sum(1 - F.col("_y")).cast("long").alias("neg"))


def tie_table_with_missing(df: DataFrame, group_cols: Sequence[str], score, label) -> DataFrame:
    """Like :func:`tie_table` but rows with a null/NaN score form their own tie
    group (score null), so coverage and AUC come from one aggregation."""
    s = _col(score).cast("double")
    s = F.when(~F.isnan(s), s)
    y = _col(label).cast("int")
    x = df.select(*group_cols, s.alias("score"), y.alias("_y")).where(F.col("_y").isNotNull())
    return x.groupBy(*group_cols, "score").agg(
        F.sum(F.col("_y")).cast("long").alias("pos"),
        F.sum(1 - F.col("_y")).cast("long").alias("neg"))


def tie_prefix(df: DataFrame, group_cols: Sequence[str], score, label) -> DataFrame:
    """Tie table plus ``pos_below, neg_below, pos_total, neg_total``."""
    t = tie_table(df, group_cols, score, label)
    return prefix_sums(t, group_cols, "score", ["pos", "neg"])


def auc_delong(df: DataFrame, group_cols: Sequence[str], score, label, *, z: float = Z95,
               round_digits: bool = True) -> DataFrame:
    """Per group: n, n_pos, auc, var, ci_lo, ci_hi (DeLong), exact with ties = 1/2.

    Groups with fewer than 2 positives or 2 negatives get a null variance and
    interval (the caller falls back to the bootstrap).
    """
    return auc_delong_ties(tie_table(df, group_cols, score, label), group_cols, z=z, round_digits=round_digits)


def auc_delong_ties(ties: DataFrame, group_cols: Sequence[str], *, z: float = Z95,
                    round_digits: bool = True) -> DataFrame:
    """DeLong AUC from a tie table ``(group.., score, pos, neg)`` (non-null scores)."""
    group_cols = list(group_cols)
    t = prefix_sums(ties, group_cols, "score", ["pos", "neg"])
    P = F.nullif(F.col("pos_total"), F.lit(0)).cast("double")  # a group of one class has no rates
    N = F.nullif(F.col("neg_total"), F.lit(0)).cast("double")
    a10 = (F.col("neg_below") + F.col("neg") / 2.0) / N
    a01 = (P - F.col("pos_below") - F.col("pos") + F.col("pos") / 2.0) / P
    per = t.select(*group_cols, "pos", "neg", "pos_total", "neg_total",
                   (F.col("pos") * a10).alias("_pa"),
                   (F.col("pos") * a10 * a10).alias("_pa2"),
                   (F.col("neg") * a01 * a01).alias("_na2"))
    g = per.groupBy(*group_cols).agg(
        F.sum(F.col("pos") + F.col("neg")).alias("n"),
        F.max("pos_total").alias("n_pos"),
        F.max("neg_total").alias("n_neg"),
        F.sum("_pa").alias("_spa"), F.sum("_pa2").alias("_spa2"), F.sum("_na2").alias("_sna2"))
    Pd, Nd = F.col("n_pos").cast("double"), F.col("n_neg").cast("double")
    auc = F.when((Pd > 0) & (Nd > 0), F.col("_spa") / Pd)
    valid = (Pd >= 2) & (Nd >= 2)
    s10 = (F.col("_spa2") - Pd * F.col("auc") * F.col("auc")) / (Pd - 1.0)
    s01 = (F.col("_sna2") - Nd * F.col("auc") * F.col("auc")) / (Nd - 1.0)
    out = g.withColumn("auc", auc).withColumn(
        "var", F.when(valid, s10 / Pd + s01 / Nd))
    half = F.lit(z) * F.sqrt(F.greatest(F.col("var"), F.lit(0.0)))
    out = out.withColumn("ci_lo", F.when(F.col("var").isNotNull(),
                                         F.greatest(F.col("auc") - half, F.lit(0.0))))
    out = out.withColumn("ci_hi", F.when(F.col("var").isNotNull(),
                                         F.least(F.col("auc") + half, F.lit(1.0))))
    rnd = r6 if round_digits else (lambda c: _col(c))
    return out.select(*group_cols, F.col("n").cast("long").alias("n"),
                      F.col("n_pos").cast("long").alias("n_pos"),
                      rnd("auc").alias("auc"), rnd("ci_lo").alias("ci_lo"),
                      rnd("ci_hi").alias("ci_hi"))


def auc_exact(df: DataFrame, group_cols: Sequence[str], score, label, **kw) -> DataFrame:
    return auc_delong(df, group_cols, score, label, **kw).select(*group_cols, "n", "n_pos", "auc")


def roc_curve(df: DataFrame, group_cols: Sequence[str], score, label) -> DataFrame:
    """(group.., threshold, tp, fp, fpr, tpr) at every distinct score.

    Positive call = score >= threshold; tp/fp are the reverse prefix sums.
    """
    t = tie_prefix(df, group_cols, score, label)
    tp = F.col("pos_total") - F.col("pos_below")
    fp = F.col("neg_total") - F.col("neg_below")
    return t.select(*group_cols, F.col("score").alias("threshold"),
                    tp.alias("tp"), fp.alias("fp"), F.col("pos_total"), F.col("neg_total"),
                    r6(F.try_divide(fp, F.col("neg_total"))).alias("fpr"),
                    r6(F.try_divide(tp, F.col("pos_total"))).alias("tpr"))


def operating_points(roc: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Youden, sens>=95 % and spec>=95 % operating points from ``roc_curve`` output.

    One aggregation with ``max_by`` per rule; ties broken by the higher threshold.
    """
    P, N = F.col("pos_total"), F.col("neg_total")
    tn = N - F.col("fp")
    fn = P - F.col("tp")
    pt = F.struct(
        F.col("threshold"),
        r6(F.col("tp") / P).alias("sens"), r6(tn / N).alias("spec"),
        r6(F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp")))).alias("ppv"),
        r6(F.when(tn + fn > 0, tn / (tn + fn))).alias("npv"))
    j = (F.col("tp") / P) - (F.col("fp") / N)
    sens = F.col("tp") / P
    spec = tn / N
    g = roc.groupBy(*group_cols).agg(
        F.max_by(pt, F.struct(j, F.col("threshold"))).alias("youden"),
        F.max_by(F.when(sens >= 0.95, pt), F.when(sens >= 0.95, F.struct(spec, F.col("threshold")))).alias("sens95"),
        F.max_by(F.when(spec >= 0.95, pt), F.when(spec >= 0.95, F.struct(sens, F.col("threshold")))).alias("spec95"))
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), F.col(k).alias("p"))
                               for k in ("youden", "sens95", "spec95")]))
    return (g.select(*group_cols, rows.alias("r"))
             .select(*group_cols, "r.rule", "r.p.threshold", "r.p.sens", "r.p.spec", "r.p.ppv", "r.p.npv"))
