"""Experiment leaderboards over a run log ``(id, task/axes.., status, metric_value, seq)``.

Winners are arg-max aggregations (``max_by``/``min_by`` over a total-order
struct), not global windows; ranks over the whole log use the distributed
prefix sums from ``ranking``; peer lookups use two per-phase aggregates
instead of a self-join that would emit all pairs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.ranking import prefix_sums


def _desc_key(metric: str, tiebreak: str) -> Column:
    """Struct whose *minimum* is the best run: higher metric first, then smaller tiebreak."""
    return F.struct((-F.col(metric)).alias("m"), F.col(tiebreak).alias("t"))


def best_run(runs: DataFrame, metric: str = "metric_value", id_col: str = "id",
             status: str | None = "complete", seq_col: str = "seq") -> DataFrame:
    """The best run; of equal metrics, the first in history (``seq_col``)."""
    x = runs.where(F.col(metric).isNotNull())
    if status:
        x = x.where(F.col("status") == status)
    return x.agg(F.min_by(F.struct(id_col, metric), _desc_key(metric, seq_col)).alias("b")).select("b.*")


def best_per_task(runs: DataFrame, task: str, metric: str = "metric_value", id_col: str = "id", seq_col: str = "seq") -> DataFrame:
    """Best complete run per task (null metric counts as 0); when a task has no
    complete run, its best over all runs. Also the task's run count. Of equal
    metrics the first in history wins; rows without a task are skipped."""
    runs = runs.where(F.col(task).isNotNull())
    m0 = F.coalesce(F.col(metric), F.lit(0.0))
    done = F.col("status") == "complete"
    key_all = F.struct((-m0).alias("m"), F.col(seq_col).alias("t"))
    key_done = F.when(done, key_all)
    g = runs.groupBy(task).agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.sum(done.cast("int")).alias("n_complete"),
        F.min_by(F.struct(F.col(id_col).alias("id"), m0.alias("metric")), key_done).alias("bd"),
        F.min_by(F.struct(F.col(id_col).alias("id"), m0.alias("metric")), key_all).alias("ba"))
    b = F.when(F.col("n_complete") > 0, F.col("bd")).otherwise(F.col("ba"))
    return g.select(task, "n_runs", b.id.alias("best_id"), b.metric.alias("best_metric"))


def rank_leaderboard(runs: DataFrame, metric: str = "metric_value", out: str = "rank") -> DataFrame:
    """SQL ``rank()`` by metric descending = 1 + #runs with a strictly higher metric,
    computed from tie counts with distributed prefix sums (no global window)."""
    x = runs.where(F.col(metric).isNotNull())
    ties = x.groupBy(metric).agg(F.count(F.lit(1)).alias("_c")).withColumn("_neg", -F.col(metric))
    p = prefix_sums(ties, [], "_neg", ["_c"])
    return x.join(p.select(metric, (F.col("_c_below") + 1).alias(out)), metric)


def axis_matrix(runs: DataFrame, axis: str, target: str, metric: str = "metric_value") -> DataFrame:
    """Long form of the axis x target matrix: best metric over complete runs
    (nulls skipped) and a winner flag per target column (all ties win)."""
    x = runs.where((F.col("status") == "complete") & F.col(metric).isNotNull())
    cell = x.groupBy(axis, target).agg(F.max(metric).alias("best"))
    col_best = cell.groupBy(target).agg(F.max("best").alias("_cb"))
    return cell.join(col_best, target).select(axis, target, "best",
                                              (F.col("best") == F.col("_cb")).alias("is_winner"))


# fixed values: axis names taken as the target where none is declared, in this order
TARGET_NAMES = ("target", "gene", "pathogen", "disease", "label", "task")


def target_axes(axes: Mapping[str, Sequence[str]], declared: str | Sequence[str] | None = None) -> list[str | None]:
    """Declared target axes that exist; else the first usual name that does; else none (one column of best values)."""
    if isinstance(declared, str):
        found = [declared] if declared in axes else []
    else:
        found = [t for t in declared or () if t in axes]
    if declared is None or isinstance(declared, str) and not found:
        found = [t for t in TARGET_NAMES if t in axes][:1]
    return found or [None]


def axis_sections(runs: DataFrame, axes: Mapping[str, Sequence[str]], target_axis: str | Sequence[str] | None = None, *,
                  axes_col: str = "axes", metric: str = "metric_value") -> DataFrame:
    """All matrices of a session in one job: for every target axis, each other axis is a section, each
    of its declared values a row, each declared target value a column.

    ``runs`` has its axis values in the map ``axes_col``; ``axes`` declares names and values in
    order (configuration, not data). A cell is the best metric of the complete runs with both values, whatever
    their other axes say; a declared cell without one is ``deferred``. A target of a single value, or none, has one column over
    all runs (``target_value`` null). Best cells of a section's column are winners, ties included.
    """
    spark = runs.sparkSession
    targets = target_axes(axes, target_axis)
    grid = [(t or "", v, a, i, x, j) for t in targets for v in (axes[t] if t and len(axes[t]) > 1 else [None])
            for i, (a, of) in enumerate((a, of) for a, of in axes.items() if a != t) for j, x in enumerate(of)]
    declared = spark.createDataFrame(grid, "target_axis string, target_value string, axis string, axis_pos int, value string, value_pos int")
    done = runs.where((F.col("status") == "complete") & F.col(metric).isNotNull())
    columns = F.array(*[F.struct(F.lit(t or "").alias("target_axis"), (F.col(axes_col)[t] if t and len(axes[t]) > 1 else F.lit(None).cast("string")).alias("target_value"))
                        for t in targets])
    x = done.select(axes_col, metric, F.explode(columns).alias("t")).select("t.*", metric, F.explode(axes_col).alias("axis", "value"))
    best = x.groupBy("target_axis", "target_value", "axis", "value").agg(F.max(metric).alias("best"))
    same = [declared[c].eqNullSafe(best[c]) for c in ("target_axis", "target_value", "axis", "value")]
    cells = declared.join(best, same, "left").select(*[declared[c] for c in declared.columns], best["best"])
    column = Window.partitionBy("target_axis", "target_value", "axis")  # as many rows as an axis has declared values
    return cells.select("*", F.when(F.col("best").isNull(), "deferred").otherwise("complete").alias("status"),
                        F.coalesce(F.col("best") == F.max("best").over(column), F.lit(False)).alias("is_winner"))


def section_winner(cells: DataFrame, axis: str, target: str, metric: str = "best", position: str | Column | None = None) -> DataFrame:
    """Per target: the axis value with the max metric; ties -> first in axis order, which ``position`` gives (else by name)."""
    place = F.col(axis) if position is None else F.col(position) if isinstance(position, str) else position
    return cells.where(F.col(metric).isNotNull()).groupBy(target).agg(
        F.min_by(F.struct(F.col(axis).alias("winner"), F.col(metric).alias("best")),
                 F.struct((-F.col(metric)).alias("m"), place.alias("a"))).alias("w")).select(target, "w.*")


def phase_cohort_matrix(runs: DataFrame, phase: str, cohort: str, seq: str,
                        metric: str = "metric_value") -> DataFrame:
    """(phase, cohort) -> metric of the last run (by ``seq``); long form of the pivot."""
    x = runs.where(F.col("status") == "complete")
    return x.groupBy(phase, cohort).agg(F.max_by(F.col(metric), F.col(seq)).alias(metric))


def topk_runs(runs: DataFrame, k: int = 3, metric: str = "metric_value", id_col: str = "id",
              objective: str = "max") -> DataFrame:
    x = runs.where((F.col("status") == "complete") & F.col(metric).isNotNull())
    o = F.col(metric).desc() if objective == "max" else F.col(metric).asc()
    return x.orderBy(o, F.col(id_col).asc()).limit(k)


def left_status(candidates: DataFrame, metrics: DataFrame, id_col: str = "id") -> DataFrame:
    """Every candidate; those without a metrics row are ``failed``."""
    j = candidates.select(id_col).join(metrics, id_col, "left")
    m = [c for c in metrics.columns if c != id_col]
    return j.select(id_col, *m, F.when(F.col(m[0]).isNull(), "failed").otherwise("complete").alias("status"))


def peer_delta(runs: DataFrame, phase: str, cohort: str, seq: str, metric: str = "metric_value",
               objective: str = "max") -> DataFrame:
    """For each complete run: the first (by ``seq``) complete run of the same
    phase with a different cohort; signed delta and better/worse.

    The first run of the phase (c1) is everyone's peer unless they share its
    cohort; those take the first run whose cohort differs from c1. Both come
    from one aggregate per (phase, cohort), and the runs are joined once to one
    row per phase.
    """
    x = runs.where((F.col("status") == "complete") & F.col(metric).isNotNull())
    firsts = x.groupBy(phase, cohort).agg(F.min(seq).alias("at"), F.min_by(metric, seq).alias("m"))
    first1 = firsts.groupBy(phase).agg(F.min_by(F.struct(F.col(cohort).alias("c1"), F.col("m").alias("m1")), "at").alias("f1")).select(phase, "f1.*")
    first2 = (firsts.join(first1, phase).where(F.col(cohort) != F.col("c1")).groupBy(phase)
              .agg(F.min_by(F.struct(F.col(cohort).alias("c2"), F.col("m").alias("m2")), "at").alias("f2")).select(phase, "f2.*"))
    z = x.join(first1.join(first2, phase, "left"), phase)
    use1 = F.col(cohort) != F.col("c1")
    peer_c = F.when(use1, F.col("c1")).otherwise(F.col("c2"))
    peer_m = F.when(use1, F.col("m1")).otherwise(F.col("m2"))
    delta = F.col(metric) - peer_m
    better = (delta > 0) if objective == "max" else ~(delta > 0)
    return (z.where(peer_c.isNotNull())
             .select("id", phase, cohort, peer_c.alias("peer_cohort"), delta.alias("delta"),
                     F.when(better, "better").otherwise("worse").alias("verdict")))


def strip_iter_prefix(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, r"^iter-\d+_", "")


def union_new_only(current: DataFrame, older: DataFrame, name: str = "config", slug: Column | None = None) -> DataFrame:
    """Append older rows only when neither their name nor their slug is already present."""
    slug = slug if slug is not None else F.col(name)
    o = older.withColumn("_slug", slug)
    o = o.join(current.select(F.col(name).alias("_slug")), "_slug", "left_anti")
    o = o.join(current.select(name), name, "left_anti").drop("_slug")
    return current.unionByName(o)


def map_label(m) -> Column:
    """map -> 'k=v, k2=v2' in key order."""
    m = F.col(m) if isinstance(m, str) else m
    entries = F.array_sort(F.map_entries(m))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ", ")


def format_hparams(hp) -> Column:
    """Hyper-parameter map -> text chosen by which keys exist."""
    hp = F.col(hp) if isinstance(hp, str) else hp
    g = lambda k: F.element_at(hp, F.lit(k))
    return (F.when(F.map_contains_key(hp, "penalty"),
                   F.concat(F.lit("penalty="), g("penalty"), F.lit(", C="), g("C")))
             .when(F.map_contains_key(hp, "max_depth"),
                   F.concat(F.lit("max_depth="), g("max_depth"), F.lit(", n_est="), g("n_estimators"),
                            F.lit(", lr="), g("learning_rate")))
             .when(F.map_contains_key(hp, "hidden"),
                   F.concat(F.lit("hidden=("), F.regexp_replace(g("hidden"), "-", ", "), F.lit("), alpha="), g("alpha")))
             .otherwise(F.lit("")))


def hpo_wide(runs_kv: DataFrame, id_col: str = "id", keys: Sequence[str] | None = None) -> DataFrame:
    """Long (id, key, value double) -> wide one column per key, plus ``best_<key>``
    flags (value equals the max over runs; maxima are one aggregated row)."""
    w = runs_kv.groupBy(id_col).pivot("key", list(keys) if keys else None).agg(F.first("value"))
    ks = [c for c in w.columns if c != id_col]
    from riskloom.functions.stats import one_row
    mx = one_row(w.agg(*[F.max(F.col(f"`{k}`")).alias(f"m{i}") for i, k in enumerate(ks)]))
    return w.select(id_col, *[F.col(f"`{k}`") for k in ks],
                    *[F.coalesce(F.col(f"`{k}`") == mx[f"m{i}"], F.lit(False)).alias(f"best_{k}")
                      for i, k in enumerate(ks)])
