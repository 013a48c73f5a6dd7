"""Model jobs on pyspark.ml: feature pipelines, estimators, scoring, coefficients,
round-trip verification. Searches and recipes are in ``plans.search``.

Fits are distributed (``pyspark.ml``); the driver reads bounded metadata only
(levels, feature names, coefficients). Evaluation uses the exact tie-group
AUC/DeLong from ``operators.metrics``.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

import numpy as np
from pyspark import SparkContext
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier)
from pyspark.ml.common import _py2java
from pyspark.ml.feature import (OneHotEncoder, StandardScaler, StandardScalerModel, StringIndexer, StringIndexerModel,
                                VectorAssembler, VectorSlicer)
from pyspark.ml.linalg import Vectors
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators import encode as EN
from riskloom.operators import metrics as M

TASK_ROWS, CORE_TASKS, LOSS_CORES = 20_000, 1, 4


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in as many partitions as its rows are worth, at most ``CORE_TASKS`` for each core.

    An iteration is a job whose tasks each send their results to the driver, so more rows must not mean more tasks.
    """
    most = CORE_TASKS * df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(1, min(most, -(-rows // TASK_ROWS))))


def for_logreg(df: DataFrame) -> DataFrame:
    """``df`` in one partition for every ``LOSS_CORES`` cores at most.

    A search evaluates the loss in thousands of jobs, and a task sends some 10 KB of metrics whatever its rows; four fits run at
    the same time, so that all cores have work.
    """
    return df.coalesce(max(1, df.sparkSession.sparkContext.defaultParallelism // LOSS_CORES))


def fit_features(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], *, scale: bool = True,
                 out: str = "features") -> PipelineModel:
    """Index + one-hot + assemble (+ divide by std, no centring), fitted on ``train``.

    The lexicographically first level of each column is dropped, and a level unseen in
    training is all zeros like it. Levels (bounded by the vocabulary) reach the driver.
    """
    idx, ohe = [f"{c}__idx" for c in categorical], [f"{c}__ohe" for c in categorical]
    stages, sizes = [], []
    if categorical:
        # descending, so that the first level is last; unseen levels get one index more, which one-hot drops
        index = StringIndexer(inputCols=list(categorical), outputCols=idx, handleInvalid="keep", stringOrderType="alphabetDesc").fit(train)
        sizes = [len(x) for x in index.labelsArray]
        stages += [index, OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True, handleInvalid="error").fit(index.transform(train.limit(1)))]
    stages.append(VectorAssembler(inputCols=list(numeric) + ohe, outputCol="_all", handleInvalid="keep"))
    at, slots = len(numeric), list(range(len(numeric)))
    for n in sizes:
        slots += range(at, at + n - 1)
        at += n
    stages.append(VectorSlicer(inputCol="_all", outputCol="_raw" if scale else out, indices=slots))
    if scale:
        raw = PipelineModel(stages).transform(train)
        stages.append(StandardScaler(inputCol="_raw", outputCol=out, withMean=False, withStd=True).fit(raw))
    return PipelineModel(stages)


def _first(level: str) -> bytes:
    """Order of levels as the indexer has it."""
    return level.encode("utf-16-be", "surrogatepass")


def fit_shared(rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str], levels: Sequence[set[str]]) -> PipelineModel:
    """``fit_features`` for several training sets of ``rows`` at once, up to the assembled ``_all``, which has every level of each column.

    ``levels`` are those of all rows; ``fit_own`` gives what differs.
    """
    idx, ohe = [f"{c}__idx" for c in categorical], [f"{c}__ohe" for c in categorical]
    stages = []
    if categorical:
        sc = SparkContext.getOrCreate()
        string = sc._jvm.java.lang.String
        labels = sc._gateway.new_array(string, len(levels), 0)  # pyspark's from_arrays_of_labels fills rows of unequal length with nulls
        for i, x in enumerate(levels):
            labels[i] = sc._gateway.new_array(string, len(x))
            for j, level in enumerate(sorted(x, key=_first, reverse=True)):
                labels[i][j] = level
        index = StringIndexerModel(sc._jvm.org.apache.spark.ml.feature.StringIndexerModel(f"StringIndexer_{uuid.uuid4().hex[:12]}", labels))
        index.setInputCols(list(categorical)).setOutputCols(idx).setHandleInvalid("keep")
        stages += [index, OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True, handleInvalid="error").fit(index.transform(rows.limit(1)))]
    return PipelineModel([*stages, VectorAssembler(inputCols=list(numeric) + ohe, outputCol="_all", handleInvalid="keep")])


def fit_own(shared: PipelineModel, n_numeric: int, levels: Sequence[set[str]], moments: Sequence[tuple[int, np.ndarray, np.ndarray]], out: str = "features") -> PipelineModel:
    """The rest of ``fit_features`` for one training set: its levels but the first of each column, divided by its std.

    ``moments`` has count, mean and variance of ``_all`` in each of the parts that make up the set.
    """
    labels = shared.stages[0].labelsArray if len(shared.stages) > 1 else []
    at, slots = n_numeric, list(range(n_numeric))
    for every, own in zip(labels, levels, strict=True):
        first = min(own, key=_first, default=None)
        slots += [at + k for k, x in enumerate(every) if x in own and x != first]
        at += len(every)
    n = sum(c for c, _, _ in moments)
    start = moments[0][1]
    mean = start + sum(c * (m - start) for c, m, _ in moments) / n  # exact where all are equal, so that a constant has no std
    squares = sum((c - 1) * v + c * (m - mean) ** 2 for c, m, v in moments)
    std = np.sqrt(squares / (n - 1)) if n > 1 else np.zeros(len(mean))
    sc = SparkContext.getOrCreate()
    vectors = [_py2java(sc, Vectors.dense(x[slots])) for x in (std, mean)]
    scaler = StandardScalerModel(sc._jvm.org.apache.spark.ml.feature.StandardScalerModel(f"StandardScaler_{uuid.uuid4().hex[:12]}", *vectors))
    return PipelineModel([VectorSlicer(inputCol="_all", outputCol="_raw", indices=slots), scaler.setInputCol("_raw").setOutputCol(out)])


def fit_native(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], out: str = "features") -> PipelineModel:
    """Codes as nominal attributes, which trees split as categories; an unseen level is a level of its own."""
    idx = [f"{c}__idx" for c in categorical]
    index = StringIndexer(inputCols=list(categorical), outputCols=idx, handleInvalid="keep", stringOrderType="alphabetAsc").fit(train)
    return PipelineModel([index, VectorAssembler(inputCols=list(numeric) + idx, outputCol=out, handleInvalid="keep")])


def bins_needed(feats: PipelineModel) -> int:
    """Tree bins that hold every level of the nominal columns, the unseen one too."""
    return max([64] + [len(x) + 1 for s in feats.stages if hasattr(s, "labelsArray") for x in s.labelsArray])


def logreg(n: int, C: float = 1.0, penalty: str = "l2", weight_col: str | None = "weight"):
    """sklearn-style C -> Spark regParam = 1 / (C * sum(w)); balanced weights give sum(w) = n."""
    reg = 1.0 / (C * max(n, 1))
    kw = dict(featuresCol="features", labelCol="label", regParam=reg,
              elasticNetParam=1.0 if penalty == "l1" else 0.0, standardization=False, maxIter=400)
    if weight_col:
        kw["weightCol"] = weight_col
    return LogisticRegression(**kw)


def gbt(max_depth: int = 4, n_iter: int = 300, lr: float = 0.1, subsample: float = 0.85,
        validation_col: str | None = None, weight_col: str | None = None, seed: int = 42, bins: int = 64,
        tol: float = 0.01):
    """Boosted trees; with ``validation_col`` (true for validation rows) boosting stops once
    the validation error no longer falls by ``tol`` of itself."""
    kw = dict(featuresCol="features", labelCol="label", maxDepth=max_depth, maxIter=n_iter, stepSize=lr,
              subsamplingRate=subsample, seed=seed, maxBins=bins, maxMemoryInMB=512)
    if validation_col:
        kw |= {"validationIndicatorCol": validation_col, "validationTol": tol}
    if weight_col:
        kw["weightCol"] = weight_col
    return GBTClassifier(**kw)


def mlp(n_features: int, hidden: Sequence[int] = (64, 32), seed: int = 42, max_iter: int = 60):
    return MultilayerPerceptronClassifier(featuresCol="features", labelCol="label",
                                          layers=[n_features, *hidden, 2], seed=seed, maxIter=max_iter)


def prepare(df: DataFrame, label: str = "y_30d", balanced: bool = True) -> DataFrame:
    x = df.withColumn("label", F.col(label).cast("double"))
    if balanced:
        x = EN.class_weight_balanced(x, "label", "weight")
    return x


def fit(train: DataFrame, numeric, categorical, estimator) -> PipelineModel:
    """Fit the feature pipeline + estimator. Each stage (indexer, scaler,
    iterations) scans the training table, so it is persisted for the duration
    of the fit (recomputable from lineage if an executor is lost) and released."""
    t = train.persist()
    try:
        few = bounded(t, t.count())
        feats = fit_features(few, numeric, categorical)
        rows = feats.transform(few)
        return PipelineModel([*feats.stages, estimator.fit(for_logreg(rows) if isinstance(estimator, LogisticRegression) else rows)])
    finally:
        t.unpersist()


def predict_proba(model: PipelineModel, df: DataFrame, key: str = "row_id", label: str = "y_30d",
                  model_name: str = "model") -> DataFrame:
    """(model, row_id, y, p) with p = P(y = 1)."""
    s = model.transform(df)
    return s.select(F.lit(model_name).alias("model"), key, F.col(label).cast("int").alias("y"),
                    vector_to_array("probability")[1].alias("p"))


def feature_names(model: PipelineModel, df: DataFrame, col: str = "_raw") -> list[str]:
    """Names from the assembled vector's ML attribute metadata (bounded by #features)."""
    meta = model.transform(df.limit(0)).schema[col].metadata.get("ml_attr", {}).get("attrs", {})
    names = {}
    for kind in meta.values():
        for a in kind:
            names[a["idx"]] = a["name"]
    return [names[i] for i in sorted(names)]


def coef_table(model: PipelineModel, df: DataFrame) -> DataFrame:
    """(feature, coef) for a fitted logistic pipeline."""
    lr = model.stages[-1]
    names = feature_names(model, df)
    coefs = lr.coefficients.toArray().tolist()
    spark = df.sparkSession
    return spark.createDataFrame(list(zip(names, [float(c) for c in coefs])), "feature string, coef double")


def topk_coefs(coefs: DataFrame, k: int = 10) -> DataFrame:
    from riskloom.operators.shift import topk_both_ends
    return topk_both_ends(coefs, "coef", k)


def sink_predictions(pred: DataFrame, path: str) -> None:
    """Parquet partitioned by model (pruned on read by ``load_predictions``)."""
    pred.write.mode("overwrite").partitionBy("model").parquet(path)


def load_predictions(spark, path: str, preference: Sequence[str]) -> DataFrame:
    """Scores of the first model in ``preference`` that exists in the table."""
    t = spark.read.parquet(path)
    present = {r["model"] for r in t.select("model").distinct().collect()}  # model names only
    for m in preference:
        if m in present:
            return t.where(F.col("model") == m)
    raise FileNotFoundError(f"none of {list(preference)} under {path}")


def verify_roundtrip(spark, pred: DataFrame, path: str, tol: float = 1e-4) -> float:
    """Write predictions, read them back, recompute the AUC; raise if it moved."""
    a0 = M.auc_exact(pred, ["model"], "p", "y").first()["auc"]
    sink_predictions(pred, path)
    back = spark.read.parquet(path)
    a1 = M.auc_exact(back, ["model"], "p", "y").first()["auc"]
    if a0 is None or a1 is None or abs(a0 - a1) > tol:
        marker = os.path.join(path, "_ROUNDTRIP_FAILED")
        spark.createDataFrame([(float(a0 or -1), float(a1 or -1))], "memory double, disk double") \
            .coalesce(1).write.mode("overwrite").json(marker)
        raise AssertionError(f"round-trip AUC mismatch: {a0} vs {a1}")
    return a1


def persist_model(model: PipelineModel, path: str) -> None:
    """Save the fitted pipeline (indexers, scaler, column list, estimator) together."""
    model.write().overwrite().save(path)


def fit_mlp(train: DataFrame, numeric, categorical, hidden: Sequence[int] = (64, 32), seed: int = 42) -> PipelineModel:
    """Fit the feature stages first to learn the vector width, then the MLP."""
    t = train.persist()
    try:
        few = bounded(t, t.count())
        feats = fit_features(few, numeric, categorical)
        return PipelineModel([*feats.stages, mlp(len(feature_names(feats, t)), hidden, seed).fit(feats.transform(few))])
    finally:
        t.unpersist()
