"""Bootstrap intervals with keyed Poisson(1) weights, replicates as arrays.

A row's weight in replicate ``r`` is Poisson(1) by inversion of a 32-bit draw that two hash
words of its key and ``r`` are mixed to, so every replicate is replayable,
independent of partitions, and the same in SQL.

Rows cross the network once, without replicates: they are dealt by ranges of (group, score,
hash), and each partition sums its own rows into arrays with one entry for each
replicate. A partition returns at most three *segments* a group: its least and its
greatest score (which neighbours may share, however many rows have that score),
and all scores between them, with the pairs already counted inside. Only segments
are exploded by replicate, so the second shuffle grows with partitions x replicates.
Counts are integers, so the sums do not depend on any order.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.stats import r6
from riskloom.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need numpy and pyarrow only

POISSON_MAX = 12  # cuts nothing: P(K > 12) is below the step of the 32-bit draw
# fixed values: the multipliers of the draw
STEP, MIX_A, MIX_B = 0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35
CELLS = 1 << 21  # weights held at once
AUC_REPLICATES, FALLBACK_REPLICATES, BAND_REPLICATES = 1000, 500, 2000


def poisson1_steps(kmax: int = POISSON_MAX) -> list[int]:
    """Least 32-bit draw of weight k + 1 or more, k = 0..kmax-1, for K ~ Poisson(1)."""
    out, acc = [], 0.0
    for k in range(kmax):
        acc += math.exp(-1.0) / math.factorial(k)
        out.append(math.ceil(acc * 2.0 ** 32))
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint32(16))) * np.uint32(MIX_A)
    x = (x ^ (x >> np.uint32(13))) * np.uint32(MIX_B)
    return x ^ (x >> np.uint32(16))


def weights(a: np.ndarray, b: np.ndarray, reps: np.ndarray) -> np.ndarray:
    """Poisson(1) weights ``[rows, replicates]`` from two hash words of each row."""
    x = a.astype(np.uint32)[:, None] ^ (reps.astype(np.uint32) * np.uint32(STEP))
    x = _mixed(_mixed(x) + b.astype(np.uint32)[:, None])
    return np.searchsorted(np.array(poisson1_steps(), np.uint64), x.astype(np.uint64), "right").astype(np.int64)


def sql_weight_ctes(base: str, key: str, n_boot: int, seed: int = 42) -> str:
    """DuckDB CTEs up to ``wx``: the rows of CTE ``base`` times replicates, with weight ``w``."""
    def mixed(x: str, y: str, of: str, into: str) -> str:
        return f"""{of}1 as (select *, (xor({x}, {x} >> 16) * {MIX_A}::UBIGINT) & 4294967295::UBIGINT as m1 from {of}),
{of}2 as (select *, (xor(m1, m1 >> 13) * {MIX_B}::UBIGINT) & 4294967295::UBIGINT as m2 from {of}1),
{into} as (select * exclude (m1, m2), xor(m2, m2 >> 16) as {y} from {of}2)"""
    h = f"md5(concat_ws('|', cast({key} as varchar), '{seed}', 'boot'))"
    steps = " + ".join(f"(case when u >= {t}::UBIGINT then 1 else 0 end)" for t in poisson1_steps())
    return f"""hx as (select *, ('0x' || substr({h}, 1, 8))::UBIGINT as ha, ('0x' || substr({h}, 9, 8))::UBIGINT as hb from {base}),
rx as (select hx.*, r.rep, xor(ha, (r.rep::UBIGINT * {STEP}::UBIGINT) & 4294967295::UBIGINT) as x0 from hx cross join range(1, {n_boot + 1}) r(rep)),
{mixed('x0', 'y0', 'rx', 'sx')},
tx as (select *, (y0 + hb) & 4294967295::UBIGINT as x1 from sx),
{mixed('x1', 'u', 'tx', 'ux')},
wx as (select *, {steps} as w from ux)"""


def _scored(df: DataFrame, key: str, score: str, label: str, group_cols: Sequence[str], seed: int) -> DataFrame:
    """Rows as (group, score, a, b, y), without null scores or labels; the group is its columns as JSON."""
    digest = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)), F.lit("boot")))
    group = F.to_json(F.struct(*[F.col(c).alias(str(i)) for i, c in enumerate(group_cols)])) if group_cols else F.lit("")
    s = F.col(score).cast("double")
    x = df.select(group.alias("g"), s.alias("score"), *[F.conv(F.substring(digest, i, 8), 16, 10).cast("long").alias(n) for i, n in ((1, "a"), (9, "b"))],
                  F.col(label).cast("int").alias("y"))
    return x.where(F.col("score").isNotNull() & ~F.isnan("score") & F.col("y").isNotNull())


class _Segments:
    """Sums the rows of one partition, in order of (group, score), into segments."""

    def __init__(self, n_boot: int):
        self.reps = np.arange(1, n_boot + 1)
        self.out: list[tuple] = []
        self.group = None

    def _begin(self, group):
        self.group, self.tie, self.started = group, None, False
        self.mid = None

    def _emit(self, single: bool, score: float, pos, neg, inner):
        self.out.append((self.group, single, score, pos, neg, inner))

    def end(self):
        """The rows of the group are over."""
        if self.group is None:
            return
        if self.mid is not None:
            self._emit(False, *self.mid)
        if self.tie is not None:
            self._emit(True, *self.tie, np.zeros_like(self.tie[1]))
        self.group = None

    def add(self, group, score, a, b, y):
        if group != self.group:
            self.end()
            self._begin(group)
        w = weights(a, b, self.reps)
        first = np.flatnonzero(np.r_[True, score[1:] != score[:-1]])
        pos = np.add.reduceat(w * y[:, None], first, axis=0)
        neg = np.add.reduceat(w * (1 - y)[:, None], first, axis=0)
        at = score[first]
        if self.tie is not None:
            if self.tie[0] == at[0]:
                pos[0] += self.tie[1]
                neg[0] += self.tie[2]
            else:
                at = np.r_[self.tie[0], at]
                pos, neg = np.vstack([self.tie[1], pos]), np.vstack([self.tie[2], neg])
        self.tie = (at[-1], pos[-1].copy(), neg[-1].copy())
        at, pos, neg = at[:-1], pos[:-1], neg[:-1]  # the last score may go on
        if len(at) and not self.started:
            self._emit(True, at[0], pos[0].copy(), neg[0].copy(), np.zeros_like(pos[0]))
            self.started = True
            at, pos, neg = at[1:], pos[1:], neg[1:]
        if not len(at):
            return
        if self.mid is None:
            self.mid = (at[0], *[np.zeros(len(self.reps), np.int64) for _ in range(3)])
        low, p, n, inner = self.mid
        below = n + np.cumsum(neg, axis=0) - neg
        self.mid = (low, p + pos.sum(axis=0), n + neg.sum(axis=0), inner + (pos * (2 * below + neg)).sum(axis=0))


def _segment_rows(n_boot: int):
    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        sums = _Segments(n_boot)
        rows = max(1, CELLS // n_boot)

        def taken():
            out, sums.out = sums.out, []
            for group, single, score, *arrays in out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([group]), pa.array([part], pa.int32()), pa.array([single]), pa.array([float(score)]),
                     *[pa.ListArray.from_arrays(pa.array([0, n_boot], pa.int32()), pa.array(x)) for x in arrays]],
                    names=["g", "part", "single", "score", "pos", "neg", "inner"])

        for batch in batches:
            if not batch.num_rows:
                continue
            codes = batch.column(0).dictionary_encode()
            names, code = codes.dictionary.to_pylist(), codes.indices.to_numpy(zero_copy_only=False)
            score, a, b, y = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(1, 5))
            edges = np.r_[np.flatnonzero(np.r_[True, code[1:] != code[:-1]]), len(code)]
            for x, z in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                for k in range(x, z, rows):
                    e = min(z, k + rows)
                    sums.add(names[code[x]], score[k:e], a[k:e], b[k:e], y[k:e])
                yield from taken()
        sums.end()
        yield from taken()
    return run


def _ranged(rows: DataFrame) -> DataFrame:
    """Rows in ranges of (group, score); rows of one score may lie in several."""
    by = ["g", "score", "a"]
    return rows.repartitionByRange(*by).sortWithinPartitions(*by)


def _by_replicate(segments: DataFrame) -> DataFrame:
    """(g, rep, score, single, part, pos, neg, inner): equal scores of several partitions are one."""
    x = segments.select("g", "part", "single", "score", F.posexplode(F.arrays_zip("pos", "neg", "inner")).alias("at", "v"))
    x = x.groupBy("g", (F.col("at") + 1).alias("rep"), "score", "single").agg(
        F.max("part").alias("part"), *[F.sum(f"v.{c}").alias(c) for c in ("pos", "neg", "inner")])
    return x.withColumn("inner", F.when(F.col("single"), F.col("pos") * F.col("neg")).otherwise(F.col("inner")))


def replicate_aucs(df: DataFrame, key: str, score: str, label: str, n_boot: int, *, seed: int = 42,
                   group_cols: Sequence[str] = ()) -> DataFrame:
    """(group.., rep, auc), ties = 1/2; null where a replicate has one class only."""
    schema = "g string, part int, single boolean, score double, pos array<long>, neg array<long>, inner array<long>"
    rows = _scored(df, key, score, label, group_cols, seed)
    by_rep = _by_replicate(_ranged(rows).mapInArrow(_segment_rows(n_boot), schema))
    before = Window.partitionBy("g", "rep").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    x = by_rep.withColumn("below", F.coalesce(F.sum("neg").over(before), F.lit(0)))
    x = x.groupBy("g", "rep").agg(F.sum(F.col("inner") + 2 * F.col("pos") * F.col("below")).alias("s"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    auc = F.when((F.col("p") > 0) & (F.col("n") > 0), F.col("s") / 2.0 / (F.col("p") * F.col("n")))
    if not group_cols:
        return x.select("rep", auc.alias("auc"))
    shape = df.select(*[F.col(c).alias(str(i)) for i, c in enumerate(group_cols)]).schema
    g = F.from_json("g", shape)
    return x.select(*[g[str(i)].alias(c) for i, c in enumerate(group_cols)], "rep", auc.alias("auc"))


def _interval(reps: DataFrame, group_cols: Sequence[str], level: float) -> DataFrame:
    a = (1.0 - level) / 2.0
    return reps.where(F.col("auc").isNotNull()).groupBy(*group_cols).agg(
        r6(F.percentile("auc", a)).alias("ci_lo"), r6(F.percentile("auc", 1.0 - a)).alias("ci_hi"),
        F.count(F.lit(1)).alias("n_boot_used"))


def auc_bootstrap_ci(df: DataFrame, key: str, score: str, label: str, *, n_boot: int = AUC_REPLICATES,
                     level: float = 0.95, seed: int = 42, group_cols: Sequence[str] = ()) -> DataFrame:
    """Point AUC on the full sample plus percentile interval (linear
    interpolation, exact ``percentile``) over replicates that contain both
    classes; ``n_boot_used`` says how many did."""
    from riskloom.operators.metrics import auc_exact
    ci = _interval(replicate_aucs(df, key, score, label, n_boot, seed=seed, group_cols=group_cols), list(group_cols), level)
    point = auc_exact(df, list(group_cols), score, label).select(*group_cols, "auc")
    if group_cols:
        return point.join(ci, list(group_cols))
    from riskloom.functions.stats import one_row
    c = one_row(ci)
    return point.select("auc", c["ci_lo"].alias("ci_lo"), c["ci_hi"].alias("ci_hi"), c["n_boot_used"].alias("n_boot_used"))


def auc_ci(df: DataFrame, key: str, score: str, label: str, *, group_cols: Sequence[str], n_boot: int = FALLBACK_REPLICATES,
           level: float = 0.95, seed: int = 42) -> DataFrame:
    """AUC of each group with DeLong's interval, or with the bootstrap's where that has none.

    DeLong needs two rows of each class. Only rows of groups with a single row of
    one class are drawn again; a group of one class has neither (method ``none``).
    Group keys must not be null.
    """
    from riskloom.operators.metrics import auc_delong
    by = list(group_cols)
    exact = auc_delong(df, by, score, label)
    s, y = F.col(score).cast("double"), F.col(label).cast("int")
    seen = df.where(s.isNotNull() & ~F.isnan(s) & y.isNotNull())
    counts = seen.groupBy(*by).agg(F.sum(y).alias("__p"), F.sum(1 - y).alias("__n"))
    lone = counts.where(F.least("__p", "__n") == 1).select(*by)
    ci = _interval(replicate_aucs(seen.join(lone, by, "left_semi"), key, score, label, n_boot, seed=seed, group_cols=by), by, level)
    ci = ci.withColumnsRenamed({"ci_lo": "__lo", "ci_hi": "__hi", "n_boot_used": "__used"})
    out = exact.join(ci, by, "left")
    return out.select(*by, "n", "n_pos", "auc", F.coalesce("ci_lo", "__lo").alias("ci_lo"), F.coalesce("ci_hi", "__hi").alias("ci_hi"),
                      F.when(F.col("ci_lo").isNotNull(), "delong").when(F.col("__lo").isNotNull(), "bootstrap").otherwise("none").alias("method"),
                      F.coalesce("__used", F.lit(0)).cast("long").alias("n_boot_used"))


def interp_grid(x: np.ndarray, y: np.ndarray, total_x: int, total_y: int, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Grid places ``0..steps`` that a rising curve of counts covers, and the curve there.

    Vertices are ``(x / total_x, y / total_y)``; on a vertical piece the curve is its top.
    """
    place = np.arange(-(-x[0] * steps // total_x), x[-1] * steps // total_x + 1)
    at = np.searchsorted(x * steps, place * total_x, "right") - 1  # the last vertex at or before the place
    after = np.minimum(at + 1, len(x) - 1)
    x0, x1, y0, y1 = x[at] / total_x, x[after] / total_x, y[at] / total_y, y[after] / total_y
    g = place / float(steps)
    with np.errstate(invalid="ignore", divide="ignore"):
        return place, np.where(x1 > x0, y0 + (y1 - y0) * (g - x0) / (x1 - x0), y0)


def _grid_rows(n_boot: int, steps: int):
    """Rows of a partition between its least and greatest score, and the counts above them, to grid points."""
    def run(rows, above):
        score = rows["score"].to_numpy()
        inner = (score > score.min(initial=np.inf)) & (score < score.max(initial=-np.inf))
        by = np.argsort(-score[inner], kind="stable")
        score = score[inner][by]
        a, b, y = (rows[c].to_numpy()[inner][by] for c in ("a", "b", "y"))
        out = []
        if len(score) and len(above):
            first = np.flatnonzero(np.r_[True, score[1:] != score[:-1]])
            of = above.sort_values("rep")
            wide = max(1, CELLS // len(score))
            for k in range(0, len(of), wide):
                part = of.iloc[k: k + wide]
                w = weights(a, b, part["rep"].to_numpy())
                tp = np.cumsum(np.add.reduceat(w * y[:, None], first, axis=0), axis=0)
                fp = np.cumsum(np.add.reduceat(w * (1 - y)[:, None], first, axis=0), axis=0)
                for j, r in enumerate(part.itertuples()):
                    if r.p_all and r.n_all:
                        place, tpr = interp_grid(np.r_[0, fp[:, j]] + r.fp, np.r_[0, tp[:, j]] + r.tp, r.n_all, r.p_all, steps)
                        out += zip([r.rep] * len(place), place.tolist(), tpr.tolist(), strict=True)
        import pandas as pd
        return pd.DataFrame(out, columns=["rep", "gi", "tpr"]).astype({"rep": "int64", "gi": "int64", "tpr": "float64"})
    return run


def roc_band_bootstrap(df: DataFrame, key: str, score: str, label: str, *, n_boot: int = BAND_REPLICATES,
                       grid_points: int = 101, seed: int = 42) -> DataFrame:
    """Pointwise ROC band: each replicate's ROC is interpolated onto a fixed grid of false positive
    rates (0 at 0); per grid point the 2.5 / 97.5 % quantiles and the mean of the true positive rate.

    First every segment's counts; with those of all segments above it, each
    partition then interpolates its own stretch of all curves, and a score that
    neighbours share gives one straight piece.
    """
    m = grid_points - 1
    schema = "g string, part int, single boolean, score double, pos array<long>, neg array<long>, inner array<long>"
    rows = cut_lineage(_ranged(_scored(df, key, score, label, (), seed)).withColumn("part", F.spark_partition_id()))
    by_rep = cut_lineage(_by_replicate(rows.drop("part").mapInArrow(_segment_rows(n_boot), schema)))
    above = Window.partitionBy("rep").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("rep")
    met = by_rep.select("rep", "part", "single", "pos", "neg", F.coalesce(F.sum("pos").over(above), F.lit(0)).alias("tp"), F.coalesce(F.sum("neg").over(above), F.lit(0)).alias("fp"),
                        F.sum("pos").over(whole).alias("p_all"), F.sum("neg").over(whole).alias("n_all")).where("p_all > 0 and n_all > 0")
    inside = rows.groupBy("part").cogroup(met.where("not single").select("part", "rep", "tp", "fp", "p_all", "n_all").groupBy("part")).applyInPandas(
        _grid_rows(n_boot, m), "rep long, gi long, tpr double")
    lo, hi = F.ceil(F.col("fp") * m / F.col("n_all")), F.floor((F.col("fp") + F.col("neg")) * m / F.col("n_all"))
    x0, x1, y0, y1 = F.col("fp") / F.col("n_all"), (F.col("fp") + F.col("neg")) / F.col("n_all"), F.col("tp") / F.col("p_all"), (F.col("tp") + F.col("pos")) / F.col("p_all")
    g = F.col("gi") / F.lit(float(m))
    pieces = (met.where("single").where(hi >= lo).withColumn("gi", F.explode(F.sequence(lo, hi)))
              .select(F.col("rep").cast("long").alias("rep"), F.col("gi").cast("long").alias("gi"), F.when(x1 > x0, y0 + (y1 - y0) * (g - x0) / (x1 - x0)).otherwise(y1).alias("tpr")))
    per = inside.unionByName(pieces).groupBy("rep", "gi").agg(F.max("tpr").alias("tpr"))
    per = per.withColumn("tpr", F.when(F.col("gi") == 0, F.lit(0.0)).otherwise(F.col("tpr")))
    return per.groupBy("gi").agg(
        r6(F.percentile("tpr", 0.025)).alias("tpr_lo"), r6(F.percentile("tpr", 0.975)).alias("tpr_hi"),
        r6(F.avg("tpr")).alias("tpr_mean")).select((F.col("gi") / float(m)).alias("fpr"), "tpr_lo", "tpr_hi", "tpr_mean")
