"""Logistic regression with an L2 penalty over more rows than memory holds.

What ``LogisticRegression`` minimises without standardization (the weighted mean of the log loss, plus half the
penalty times the squared coefficients; the intercept goes free) is minimised by Newton's method, to a closer
tolerance: six to eight passes over the rows instead of a hundred. The vectors are packed once, as
compressed columns of ``BLOCK_ROWS`` rows; a pass streams them, and a task returns its sums of the loss,
gradient and second derivatives. So a task holds one block, and the driver one matrix for each core.
"""

from __future__ import annotations

import sys
import uuid

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import checkpoint_dir, delete_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need numpy and pyarrow only
STREAM_ROWS = 4_000_000  # training rows from which a fit streams; in memory a row takes some 0.4 KB
BLOCK_ROWS, FILE_BLOCKS = 4096, 64
STEPS, HALVINGS, CLOSE = 60, 30, 0.1


def dense(features: pa.StructArray, width: int) -> np.ndarray:
    """A row for each vector, sparse or dense."""
    n = len(features)
    values = features.field("values")
    count = values.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    is_dense = features.field("type").to_numpy(zero_copy_only=False) == 1
    of = np.repeat(is_dense, count)
    at = np.empty(len(of), np.int64)
    at[~of] = features.field("indices").flatten().to_numpy(zero_copy_only=False)
    at[of] = np.tile(np.arange(width), int(is_dense.sum()))
    out = np.zeros((n, width))
    out[np.repeat(np.arange(n), count), at] = values.flatten().to_numpy(zero_copy_only=False)
    return out


def _packer(width: int):
    def run(batches):
        codec = pa.Codec("zstd", compression_level=1)
        for whole in batches:
            for k in range(0, whole.num_rows, BLOCK_ROWS):
                b = whole.slice(k, BLOCK_ROWS)
                columns = np.ascontiguousarray(dense(b.column(0), width).T)
                y, w = (b.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in (1, 2))
                yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), *[pa.array([x], pa.binary()) for x in (codec.compress(columns, asbytes=True), y.tobytes(), w.tobytes())]],
                                                 names=["n", "x", "y", "w"])
    return run


def _summer(width: int, beta: np.ndarray):
    """Sums over the rows of a task: weight, weight of positives, loss, then gradient and second derivatives with the intercept last."""
    def run(batches):
        codec = pa.Codec("zstd")
        total, grad, hess = np.zeros(3), np.zeros(width + 1), np.zeros((width + 1, width + 1))
        for b in batches:
            for n, x, y, w in zip(b.column(0).to_pylist(), *b.columns[1:], strict=True):
                x = np.frombuffer(codec.decompress(x.as_buffer(), width * n * 8)).reshape(width, n)
                y, w = np.frombuffer(y.as_buffer()), np.frombuffer(w.as_buffer())
                margin = beta[:-1] @ x + beta[-1]
                p = 0.5 * (1.0 + np.tanh(0.5 * margin))
                total += w.sum(), w @ y, w @ (np.logaddexp(0.0, margin) - y * margin)
                rest, curve = w * (p - y), w * p * (1.0 - p)
                grad += np.append(x @ rest, rest.sum())
                bent = x * np.sqrt(curve)
                hess[:-1, :-1] += bent @ bent.T  # of one array, half the work
                side = x @ curve
                hess[:-1, -1] += side
                hess[-1, :-1] += side
                hess[-1, -1] += curve.sum()
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([total, grad, hess.ravel()]).tobytes()], pa.binary())], names=["sums"])
    return run


def minimum(rows: DataFrame, width: int, reg: float, tol: float, tasks: int) -> np.ndarray | None:
    """Coefficients and intercept over packed ``rows``; None where they don't exist or numbers overflow."""
    def at(beta):
        sums = np.zeros(3 + (width + 1) * (width + 2))
        for r in rows.coalesce(tasks).mapInArrow(_summer(width, beta), "sums binary").collect():  # a row for each core
            sums += np.frombuffer(r["sums"])
        weight, positive = sums[:2]
        if not 0 < positive < weight:
            return None
        grad, hess = sums[3:width + 4] / weight, sums[width + 4:].reshape(width + 1, width + 1) / weight
        grad[:-1] += reg * beta[:-1]
        hess[np.arange(width), np.arange(width)] += reg
        return sums[2] / weight + 0.5 * reg * beta[:-1] @ beta[:-1], grad, hess

    beta = np.zeros(width + 1)
    here = at(beta)
    for _ in range(STEPS):
        if here is None or not all(np.all(np.isfinite(x)) for x in here):
            return None
        loss, grad, hess = here
        try:
            step = np.linalg.solve(hess, -grad)
        except np.linalg.LinAlgError:
            return None
        gain = -grad @ step
        if not np.isfinite(gain) or gain < 0:
            return None
        if gain < CLOSE * tol * loss:  # the estimator would stop at a gain of ``tol``
            return beta + step
        size = 1.0
        for _ in range(HALVINGS):
            there = at(beta + size * step)
            if there is not None and there[0] <= loss:
                break
            size /= 2
        else:
            return None
        beta, here = beta + size * step, there
    return None


def fit(estimator: LogisticRegression, rows: DataFrame, width: int) -> LogisticRegressionModel | None:
    """The model of ``estimator`` (binary, L2, no standardization) for vectors of ``width``; None where Newton's method finds none."""
    spark = rows.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/packed-{uuid.uuid4().hex}"
    given = rows.select(F.unwrap_udt(estimator.getFeaturesCol()).alias("x"), F.col(estimator.getLabelCol()).alias("y"),
                        (F.col(estimator.getWeightCol()) if estimator.isDefined("weightCol") else F.lit(1.0)).alias("w"))
    try:
        given.mapInArrow(_packer(width), "n long, x binary, y binary, w binary").write.option("maxRecordsPerFile", FILE_BLOCKS).parquet(path)
        beta = minimum(spark.read.schema("n long, x binary, y binary, w binary").parquet(path), width, estimator.getRegParam(), estimator.getTol(), spark.sparkContext.defaultParallelism)
    finally:
        delete_path(spark, path)
    if beta is None:
        return None
    sc = spark.sparkContext
    found = sc._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(estimator.uid, _py2java(sc, Vectors.dense(beta[:-1])), float(beta[-1]))
    return estimator._copyValues(LogisticRegressionModel(found))
