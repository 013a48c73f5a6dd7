"""Validation search, group cross-validation, early stopping, shift evaluation, named recipes.

A split's feature vectors are built once and kept for all fits on it. Fits of a
grid run at the same time from driver threads, each a set of Spark jobs; all
validation scores are compared in one grouped AUC job, and the first of equal
configurations wins.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators import features as FE
from riskloom.operators import metrics as M
from riskloom.operators import split as S
from riskloom.operators.bootstrap import auc_ci
from riskloom.plans import models as MD
from riskloom.plans import newton as NW
from riskloom.session import checkpoint_dir, cut_lineage, delete_path, drop_cut

PARALLEL = 4
# fixed values: the study's grids
LOGREG_GRID = tuple({"penalty": p, "C": c} for p in ("l1", "l2") for c in (0.01, 0.1, 1.0))
GBT_GRID = tuple({"max_depth": d, "n_iter": n, "lr": r} for d in (4, 6) for n in (300, 600) for r in (0.05, 0.1))
MLP_GRID = ({"hidden": (32,)}, {"hidden": (64, 32)})
SHIFT_GRID = tuple({"penalty": "l2", "C": c} for c in (0.01, 0.1, 1.0))


@dataclass
class Vectors:
    """Feature vectors of a split: ``rows`` has row_id, y, split, label, features and both weights, is stored without its lineage until the end."""

    rows: DataFrame
    feats: PipelineModel
    n: int  # training rows
    ratio: float  # negatives per positive among them
    width: int
    bins: int

    def part(self, *splits: str) -> DataFrame:
        return self.rows.where(F.col("split").isin(*splits))


@contextmanager
def vectors(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], *, native: bool = False, train: str = "train"):
    """Vectors of ``df`` (row_id, y_30d, split and the features), fitted on its training rows; released at the end."""
    given = df.persist()
    try:
        taught = given.where(F.col("split") == train)
        feats = (MD.fit_native if native else MD.fit_features)(taught, numeric, categorical)
        seen = given.groupBy("split", "y_30d").count().collect()  # two rows for each split
        count = {int(r["y_30d"]): r["count"] for r in seen if r["split"] == train}
        n, pos = sum(count.values()), count.get(1, 0)
        of = {y: n / (2.0 * c) for y, c in count.items()}
        ratio = (n - pos) / max(pos, 1)
        y = F.col("y_30d").cast("int")
        rows = cut_lineage(feats.transform(MD.bounded(given, sum(r["count"] for r in seen))).select(  # every task of every iteration would bring the lineage
            "row_id", y.alias("y"), "split", F.col("y_30d").cast("double").alias("label"), "features",
            F.when(y == 1, of.get(1, 1.0)).otherwise(of.get(0, 1.0)).alias("balanced"), F.when(y == 1, ratio).otherwise(1.0).alias("boosted")))
    finally:
        given.unpersist()
    try:
        width = len(MD.feature_names(feats, given, "features" if native else "_raw"))
        yield Vectors(rows, feats, n, ratio, width, MD.bins_needed(feats))
    finally:
        drop_cut(rows)


@contextmanager
def fold_vectors(folds: DataFrame, numeric: Sequence[str], categorical: Sequence[str]):
    """Gives the ``Vectors`` of each fold as test rows and the others as training rows: what ``vectors`` would give for each, from one table.

    One pass over ``folds`` has the levels and labels of each fold, one writes vectors of all levels, one has their moments in each fold.
    A fold's own levels and scale are then applied as its rows are read.
    """
    spark = folds.sparkSession
    given = folds.persist()
    path = f"{checkpoint_dir(spark).rstrip('/')}/folds-{uuid.uuid4().hex}"
    try:
        sets = [F.collect_set(F.col(c).cast("string")).alias(f"_{i}") for i, c in enumerate(categorical)]
        seen = given.groupBy("fold", "y_30d").agg(F.count(F.lit(1)).alias("_rows"), *sets).collect()  # two rows for each fold
        held = lambda rows: [set().union(*[r[f"_{i}"] for r in rows]) for i in range(len(categorical))]
        shared = MD.fit_shared(given, numeric, categorical, held(seen))
        n = sum(r["_rows"] for r in seen)
        table = shared.transform(given).select("row_id", F.col("y_30d").cast("int").alias("y"), "fold", F.col("y_30d").cast("double").alias("label"), "_all")
        table.coalesce(max(1, -(-n // MD.TASK_ROWS))).write.parquet(path)
        stored = spark.read.schema(table.schema).parquet(path)
    except BaseException:
        delete_path(spark, path)
        raise
    finally:
        given.unpersist()
    try:
        parts = stored.groupBy("fold").agg(Summarizer.metrics("count", "mean", "variance").summary(F.col("_all")).alias("m")).collect()  # a row for each fold
        moments = {r["fold"]: (r["m"]["count"], r["m"]["mean"].toArray(), r["m"]["variance"].toArray()) for r in parts}

        def of(i: int) -> Vectors:
            taught = [r for r in seen if r["fold"] != i]
            own = MD.fit_own(shared, len(numeric), held(taught), [m for f, m in moments.items() if f != i])
            count = {y: sum(r["_rows"] for r in taught if int(r["y_30d"]) == y) for y in {int(r["y_30d"]) for r in taught}}
            n, pos = sum(count.values()), count.get(1, 0)
            weight = {y: n / (2.0 * c) for y, c in count.items()}
            ratio = (n - pos) / max(pos, 1)
            y = F.col("y")
            rows = own.transform(stored.withColumn("split", F.when(F.col("fold") == i, "test").otherwise("train"))).select(
                "row_id", "y", "split", "label", "features",
                F.when(y == 1, weight.get(1, 1.0)).otherwise(weight.get(0, 1.0)).alias("balanced"), F.when(y == 1, ratio).otherwise(1.0).alias("boosted"))
            feats = PipelineModel([*shared.stages, *own.stages])
            return Vectors(rows, feats, n, ratio, len(own.stages[0].getIndices()), MD.bins_needed(feats))
        yield of
    finally:
        delete_path(spark, path)


def predicted(model, rows: DataFrame, name) -> DataFrame:
    """(model, row_id, y, p) of vectors."""
    return model.transform(rows).select(F.lit(name).alias("model"), "row_id", "y", vector_to_array("probability")[1].alias("p"))


def first_trees(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The model after its first ``n`` rounds of boosting."""
    if n >= model.getNumTrees:
        return model
    context = SparkContext.getOrCreate()
    jvm, j = context._jvm, model._java_obj
    trees = context._gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    rates = context._gateway.new_array(jvm.double, n)
    all_trees, all_rates = j.trees(), j.treeWeights()
    for i in range(n):
        trees[i], rates[i] = all_trees[i], all_rates[i]
    cut = jvm.org.apache.spark.ml.classification.GBTClassificationModel(f"{j.uid()}_{n}", trees, rates)
    cut.setFeaturesCol(j.getFeaturesCol())
    return GBTClassificationModel(cut)


Fit = Callable[[Vectors], list[tuple[dict, object]]]


def fit_logreg(v: Vectors, **params):
    """The logistic model of the training rows; more of them than memory is for are streamed, where the penalty has second derivatives."""
    estimator, train = MD.logreg(v.n, weight_col="balanced", **params), v.part("train")
    streamed = NW.fit(estimator, train, v.width) if v.n > NW.STREAM_ROWS and estimator.getElasticNetParam() == 0.0 else None
    return estimator.fit(MD.for_logreg(train)) if streamed is None else streamed


def logreg_fits(grid: Iterable[dict] = LOGREG_GRID) -> list[Fit]:
    return [lambda v, p=p: [(p, fit_logreg(v, **p))] for p in grid]


def mlp_fits(grid: Iterable[dict] = MLP_GRID) -> list[Fit]:
    return [lambda v, p=p: [(p, MD.mlp(v.width, **p).fit(v.part("train")))] for p in grid]


def gbt_fits(grid: Iterable[dict] = GBT_GRID, stop: bool = True) -> list[Fit]:
    """One fit for all configurations that differ in the number of trees only: fewer trees are its first rounds.

    With ``stop``, a fit ends when the validation error no longer falls, as in ``MD.gbt``.
    """
    runs: dict[tuple, list[dict]] = {}
    for p in grid:
        runs.setdefault((p["max_depth"], p["lr"]), []).append(p)

    def one(v: Vectors, of: list[dict]):
        most = max(p["n_iter"] for p in of)
        first = of[0]
        trees = MD.gbt(max_depth=first["max_depth"], n_iter=most, lr=first["lr"], weight_col="boosted", bins=v.bins,
                       validation_col="held" if stop else None)
        rows = v.part("train", "val").withColumn("held", F.col("split") == "val") if stop else v.part("train")
        model = trees.fit(rows)
        return [(p, first_trees(model, p["n_iter"])) for p in of]

    return [lambda v, of=of: one(v, of) for of in runs.values()]


@dataclass
class Choice:
    model: object
    params: dict
    auc: float
    tried: list[tuple[dict, float | None]] = field(default_factory=list)


def grid_select(v: Vectors, grid: Sequence[dict], fits: Sequence[Fit], parallelism: int = PARALLEL) -> Choice:
    """The configuration of the highest exact validation AUC, in the order of ``grid``: strict '>', so the first wins ties."""
    with ThreadPoolExecutor(parallelism) as pool:
        session = v.rows.sparkSession
        done = list(pool.map(inheritable_thread_target(session)(lambda f: f(v)), fits))
    found = sorted(((list(grid).index(p), m) for each in done for p, m in each), key=lambda x: x[0])
    val = v.part("val")
    scores = reduce(DataFrame.unionByName, [predicted(m, val, i) for i, m in found])
    aucs = {r["model"]: r["auc"] for r in M.auc_exact(scores, ["model"], "p", "y", round_digits=False).collect()}  # a row for each configuration
    best = None
    for i, m in found:
        if aucs.get(i) is not None and (best is None or aucs[i] > aucs[best[0]]):
            best = (i, m)
    if best is None:
        raise ValueError("validation rows of both classes are needed")
    return Choice(best[1], grid[best[0]], aucs[best[0]], [(grid[i], aucs.get(i)) for i, _ in found])


def cv_auc(df: DataFrame, numeric, categorical, make: Callable[[Vectors], object], *, group: str, k: int = 5,
           parallelism: int = PARALLEL) -> DataFrame:
    """(fold, n, n_pos, auc, ci_lo, ci_hi, method, n_boot_used): each fold scored by a model of the others.

    Folds keep the rows of a ``group`` together. Vectors of all folds are one table; fits run at the same time; all
    predictions are one table and one grouped interval job.
    """
    folds = S.kfold_stratified_group(df, group, "y_30d", k, key="row_id")
    with fold_vectors(folds, numeric, categorical) as of:
        def one(i: int) -> DataFrame:
            v = of(i)
            return cut_lineage(predicted(make(v), v.part("test"), i))

        with ThreadPoolExecutor(parallelism) as pool:
            parts = list(pool.map(inheritable_thread_target(df.sparkSession)(one), range(k)))
    scores = reduce(DataFrame.unionByName, parts).withColumnRenamed("model", "fold")
    return auc_ci(scores, "row_id", "p", "y", group_cols=["fold"])


def early_stop_val(v: Vectors, limit: int = 2000, max_depth: int = 5, lr: float = 0.03, tol: float = 0.01) -> GBTClassificationModel:
    """Boosting over train rows that stops on the validation rows; fewer than ``limit`` trees where it did."""
    trees = MD.gbt(max_depth=max_depth, n_iter=limit, lr=lr, weight_col="boosted", bins=v.bins, validation_col="held", tol=tol)
    return trees.fit(v.part("train", "val").withColumn("held", F.col("split") == "val"))


def shift_eval(cohort: DataFrame, numeric, categorical, *, cohort_col: str = "cohort", train_on: str = "young",
               grid: Sequence[dict] = SHIFT_GRID, seed: int = 42) -> tuple[DataFrame, Choice, DataFrame]:
    """AUC rows ``in`` and ``out`` with their difference, the chosen C, and named coefficients.

    C is picked on a validation part of the training stratum's 80 %, the model is fitted again on the whole 80 %, and scores
    the held-out 20 % (in) and the whole other stratum (out).
    """
    given = cohort.persist()  # its strata are read apart, and the training one twice
    try:
        inside = S.split_stratified(given.where(F.col(cohort_col) == train_on), "row_id", "y_30d", test=0.2, val_of_rest=0.15, purpose="shift_split", seed=seed)
        with vectors(inside, numeric, categorical) as v:
            choice = grid_select(v, grid, logreg_fits(grid))
        out = given.where(F.col(cohort_col) != train_on).withColumn("split", F.lit("out"))
        both = inside.withColumn("split", F.when(F.col("split") == "test", "in").otherwise("train")).unionByName(out.select(*inside.columns))
        with vectors(both, numeric, categorical) as v:
            model = fit_logreg(v, **choice.params)
            scores = v.part("in", "out")
            result = M.auc_delong(predicted(model, scores, "x").drop("model").join(scores.select("row_id", "split"), "row_id"), ["split"], "p", "y")
            rows = result.collect()  # two
            coefs = MD.coef_table(PipelineModel([*v.feats.stages, model]), both)
    finally:
        given.unpersist()
    schema = result.schema
    auc = {r["split"]: r["auc"] for r in rows}
    delta = auc["in"] - auc["out"] if auc.get("in") is not None and auc.get("out") is not None else None
    table = cohort.sparkSession.createDataFrame(rows, schema).withColumn("delta_auc", F.lit(delta).cast("double"))
    return table, choice, coefs


@dataclass(frozen=True)
class Recipe:
    features: str  # base | slim | te | native
    fit: Callable[[Vectors], object]


def _stacked(v: Vectors):
    """Trees and a logistic model; scored as the mean of both."""
    return [_trees()(v), fit_logreg(v)]


def _trees(stop: bool = False, **params):
    def run(v: Vectors):
        if stop:
            return early_stop_val(v, **params)
        return MD.gbt(weight_col="boosted", bins=v.bins, **params).fit(v.part("train"))
    return run


def _linear(**params):
    return lambda v: fit_logreg(v, **params)


def _network(hidden):
    return lambda v: MD.mlp(v.width, hidden).fit(v.part("train"))


#: Named recipes: what the study runs with libraries that Spark has no counterpart for (in-context transformers, dropped-tree boosting) is left out.
RECIPES: dict[str, Recipe] = {
    "logreg_l1_base": Recipe("base", _linear(C=0.1, penalty="l1")),
    "logreg_l2_base": Recipe("base", _linear(C=1.0, penalty="l2")),
    "logreg_l1_slim": Recipe("slim", _linear(C=0.1, penalty="l1")),
    "logreg_l2_bucketed": Recipe("slim", _linear(C=1.0, penalty="l2")),
    "logreg_target_enc": Recipe("te", _linear(C=1.0, penalty="l2")),
    "gbt_wide_1": Recipe("base", _trees(max_depth=4, n_iter=600, lr=0.05)),
    "gbt_wide_2": Recipe("base", _trees(max_depth=6, n_iter=300, lr=0.05)),
    "gbt_early_stop": Recipe("base", _trees(stop=True)),
    "gbt_early_stop_slim": Recipe("slim", _trees(stop=True)),
    "gbt_early_stop_raw_codes": Recipe("native", _trees(stop=True)),
    "gbt_bucketed": Recipe("base", _trees(stop=True, max_depth=6, lr=0.05)),
    "gbt_raw_codes": Recipe("native", _trees(stop=True, max_depth=6, lr=0.05)),
    "gbt_target_enc": Recipe("te", _trees(stop=True, max_depth=6, lr=0.05)),
    "mlp_32": Recipe("base", _network((32,))),
    "mlp_64_32": Recipe("base", _network((64, 32))),
    "mlp_128_64_32": Recipe("base", _network((128, 64, 32))),
    "stack_gbt_logreg": Recipe("base", _stacked),
}


def feature_frame(kind: str, split_cohort: DataFrame) -> tuple[DataFrame, list[str], list[str], bool]:
    """(row_id, y_30d, split and features), numeric and categorical names, and whether trees take the codes as they are."""
    if kind == "base":
        return FE.features_base(split_cohort, keep=["split"]), list(FE.BASE_NUMERIC), [*FE.BASE_CATEGORICAL, *FE.DRUGS, *FE.DIAG_BUCKETS], False
    if kind == "slim":
        return FE.features_slim(split_cohort, keep=["split"]), list(FE.SLIM_NUMERIC), [*FE.SLIM_CATEGORICAL, *FE.ACTIVE_DRUGS], False
    if kind == "te":
        return FE.features_te(split_cohort), [*FE.BASE_NUMERIC, *[f"{c}_te" for c in FE.TE_COLUMNS]], list(FE.LOW_CATEGORICAL), False
    if kind == "native":
        return FE.features_native_cat(split_cohort, keep=["split"]), list(FE.BASE_NUMERIC), list(FE.NATIVE_CATEGORICAL), True
    raise ValueError(kind)


def run_config(name: str, split_cohort: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fit a named recipe on split='train', score split='test': one metrics row
    (config, n_test, n_pos, auc, ci_lo, ci_hi, runtime_sec), and the predictions, stored."""
    t0 = time.time()
    recipe = RECIPES[name]
    df, numeric, categorical, native = feature_frame(recipe.features, split_cohort)
    with vectors(df, numeric, categorical, native=native) as v:
        model = recipe.fit(v)
        parts = [predicted(m, v.part("test"), name) for m in (model if isinstance(model, list) else [model])]
        pred = parts[0] if len(parts) == 1 else reduce(DataFrame.unionByName, parts).groupBy("model", "row_id").agg(F.max("y").alias("y"), F.avg("p").alias("p"))
        pred = cut_lineage(pred)
    res = M.auc_delong(pred, ["model"], "p", "y").select(F.col("model").alias("config"), F.col("n").alias("n_test"), "n_pos", "auc", "ci_lo", "ci_hi")
    row = res.first()  # one row; the time covers scoring and the metric too
    table = split_cohort.sparkSession.createDataFrame([row] if row else [], res.schema).withColumn("runtime_sec", F.lit(round(time.time() - t0, 3)))
    return table, pred
