"""Quality classifier: a linear-chain conditional random field over a document's lines.

Every line is good or bad. Its features are its own (length, words, shares of
capitals, digits, symbols and punctuation, repeated words, an equal line before
it) and the same of the line before and after; transitions link neighbours.
Training lines take their document's label, and the conditional likelihood of
whole label sequences is maximised. A document's mean of its lines' marginals
for "good", found by forward-backward and weighted by line length, goes through
a logistic calibration fitted on the training documents.

The field is fitted on at most ``FIT_ROWS`` labelled documents, taken in order
of a hash of their id; every document is scored, over its whole text. A null or
empty text is one empty line. Where one label or none is there to learn from,
every score is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm import textbytes as tb

FIT_ROWS = 4000
STEPS, RATE, RIDGE = 150, 0.1, 1e-3
CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&<>", b"|", b"!", b".,;:?", b"'\"()[]{}/\\=_-+~@^`", tb.SPACES)
OWN = len(CLASSES) + 7
WIDTH = 3 * OWN + 3


def line_features(data: np.ndarray, offsets: np.ndarray):
    """Features ``[lines, WIDTH]``, bytes of each line and each text's first line; every text has a line."""
    n = len(data)
    newline = np.flatnonzero(data == 10)
    count = np.diff(np.searchsorted(newline, offsets)) + 1
    first = np.concatenate([[0], np.cumsum(count)])
    lines = first[-1]
    text = np.repeat(np.arange(len(count)), count)
    start = np.empty(lines, np.int64)
    start[first[:-1]] = offsets[:-1]
    inner = np.ones(lines, bool)
    inner[first[:-1]] = False
    start[inner] = newline + 1
    end = np.empty(lines, np.int64)
    end[first[1:] - 1] = offsets[1:]
    inner = np.ones(lines, bool)
    inner[first[1:] - 1] = False
    end[inner] = newline
    size = end - start

    kinds = np.zeros(256, np.uint8)
    for k, members in enumerate(CLASSES, 1):
        kinds[list(members)] = k
    kinds[128:] = len(CLASSES) + 1
    of = kinds[data]
    some = np.maximum(size, 1)
    out = np.zeros((lines, OWN))
    for k in range(1, len(CLASSES) + 2):
        total = np.concatenate([[0], np.cumsum(of == k, dtype=np.int32)])
        out[:, k - 1] = (total[end] - total[start]) / some
    starts, _, hashes, _ = tb.words(data, offsets, tb.word_table())
    at = np.searchsorted(starts, start)
    words = np.searchsorted(starts, end) - at
    owner = np.repeat(np.arange(lines), words)
    by = np.lexsort((hashes, owner))
    fresh = np.ones(len(by), bool)
    fresh[1:] = (owner[by][1:] != owner[by][:-1]) | (hashes[by][1:] != hashes[by][:-1])
    distinct = np.bincount(owner[by][fresh], minlength=lines)
    p, q = tb.powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p[:n], out=total[1:])
    whole = tb.mix((total[end] - total[start]) * q[start] + size.astype(np.uint64))
    by = np.lexsort((np.arange(lines), whole, text))
    again = np.zeros(lines, bool)
    again[by[1:]] = (text[by][1:] == text[by][:-1]) & (whole[by][1:] == whole[by][:-1])
    k = len(CLASSES) + 1
    out[:, k] = np.log1p(size)
    out[:, k + 1] = np.log1p(words)
    out[:, k + 2] = np.minimum(size / np.maximum(words, 1), 40) / 10
    out[:, k + 3] = distinct / np.maximum(words, 1)
    out[:, k + 4] = again & (words > 0)
    out[:, k + 5] = words == 0
    near = np.zeros((lines, WIDTH))
    near[:, :OWN] = out
    head, tail = np.zeros(lines, bool), np.zeros(lines, bool)
    head[first[:-1]] = tail[first[1:] - 1] = True
    near[1:, OWN: 2 * OWN] = out[:-1]
    near[head, OWN: 2 * OWN] = 0
    near[:-1, 2 * OWN: 3 * OWN] = out[1:]
    near[tail, 2 * OWN: 3 * OWN] = 0
    near[:, -3], near[:, -2], near[:, -1] = head, tail, 1
    return near, size, first


def _steps(first: np.ndarray):
    """Lines by place: for each place, the lines there of all texts that reach it, longest texts first."""
    size = np.diff(first)
    by = np.argsort(-size, kind="stable")
    alive = np.searchsorted(-size[by], -np.arange(1, size.max() + 1), "right")
    return by, alive


def _log_sum(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def marginals(emit: np.ndarray, change: np.ndarray, first: np.ndarray):
    """Log partition of each text, and each line's and each neighbour pair's marginals.

    ``emit[line, label]`` and ``change[before, after]`` are log scores.
    """
    lines = len(emit)
    forward, backward = emit.copy(), np.zeros_like(emit)
    by, alive = _steps(first)
    base, last = first[:-1][by], first[1:][by] - 1
    for t, k in enumerate(alive[1:], 1):
        at = base[:k] + t
        forward[at] += _log_sum(forward[at - 1][:, :, None] + change, 1)
    for t, k in enumerate(alive[1:], 1):
        at = last[:k] - t
        backward[at] = _log_sum(change + (emit[at + 1] + backward[at + 1])[:, None, :], 2)
    total = _log_sum(forward[first[1:] - 1], 1)
    each = np.repeat(total, np.diff(first))
    node = np.exp(forward + backward - each[:, None])
    inner = np.ones(lines, bool)
    inner[first[:-1]] = False
    at = np.flatnonzero(inner)
    pair = np.exp(forward[at - 1][:, :, None] + change + (emit[at] + backward[at])[:, None, :] - each[at][:, None, None])
    return total, node, pair, at


@dataclass
class Field:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray  # [WIDTH, 2]
    change: np.ndarray  # [2, 2]
    slope: float
    shift: float
    constant: float | None = None

    def raw(self, features, size, first) -> np.ndarray:
        """Length-weighted mean marginal of "good" for each text."""
        _, node, _, _ = marginals((features - self.mean) / self.scale @ self.weight, self.change, first)
        weight = np.maximum(size, 1).astype(float)
        return np.add.reduceat(node[:, 1] * weight, first[:-1]) / np.add.reduceat(weight, first[:-1])

    def score(self, features, size, first) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(first) - 1, self.constant)
        return _squash(self.slope * _logit(self.raw(features, size, first)) + self.shift)


def _logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _squash(x):
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def fit_field(features, size, first, label: np.ndarray) -> Field:
    """Fit by Adam on the mean log likelihood of a text's labels, then calibrate."""
    if len(label) == 0 or label.min() == label.max():
        return Field(0, 1, 0, 0, 1, 0, float(label.mean()) if len(label) else 0.5)
    mean, scale = features.mean(axis=0), features.std(axis=0)
    mean[-1], scale[scale < 1e-9] = 0, 1
    x = (features - mean) / scale
    lines = np.diff(first)
    y = np.repeat(label, lines)
    texts = len(label)
    per = 1 / lines  # each text counts alike, however many lines it has
    truth = np.zeros((len(y), 2))
    truth[np.arange(len(y)), y] = 1
    each = np.repeat(per, lines)[:, None] / texts
    theta = np.zeros(WIDTH * 2 + 4)
    first_moment, second_moment = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        weight, change = theta[:-4].reshape(WIDTH, 2), theta[-4:].reshape(2, 2)
        _, node, pair, at = marginals(x @ weight, change, first)
        own = np.zeros((2, 2))
        np.add.at(own, (y[at - 1], y[at]), each[at, 0])
        grad = np.concatenate([(x.T @ ((truth - node) * each)).ravel(), (own - (pair * each[at][:, :, None]).sum(axis=0)).ravel()]) - RIDGE * theta
        first_moment = 0.9 * first_moment + 0.1 * grad
        second_moment = 0.999 * second_moment + 0.001 * grad ** 2
        theta = theta + RATE * (first_moment / (1 - 0.9 ** step)) / (np.sqrt(second_moment / (1 - 0.999 ** step)) + 1e-8)
    field = Field(mean, scale, theta[:-4].reshape(WIDTH, 2), theta[-4:].reshape(2, 2), 1.0, 0.0)
    z = _logit(field.raw(features, size, first))
    slope, shift = 1.0, 0.0
    for _ in range(25):  # Newton steps, with a small ridge towards the uncalibrated score
        p = _squash(slope * z + shift)
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((label - p) * z).sum() - (slope - 1), (label - p).sum() - shift])
        h = np.array([[(w * z * z).sum() + 1, (w * z).sum()], [(w * z).sum(), w.sum() + 1]])
        move = np.linalg.solve(h, g)
        slope, shift = slope + move[0], shift + move[1]
    field.slope, field.shift = float(max(slope, 1e-3)), float(shift)
    return field


def _feature_rows(batches):
    tb.lean()
    for b in batches:
        labels = b.column(0).to_numpy(zero_copy_only=False)
        for r0, r1, data, offsets in tb.chunks(b.column(1)):
            near, size, first = line_features(data, offsets)
            edges = pa.array(first.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(labels[r0:r1]), pa.ListArray.from_arrays(edges, pa.array(size)),
                 pa.ListArray.from_arrays(pa.array((first * WIDTH).astype(np.int32)), pa.array(near.astype(np.float32).ravel()))],
                names=["label", "size", "x"])


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", fit_rows: int = FIT_ROWS) -> Field:
    """Learn from rows of ``labels`` where ``learn`` is true and the label isn't null."""
    known = labels.where(learn & F.col(label_col).isNotNull()).select(F.col(id_col).alias("__id"), F.col(label_col).cast("long").alias("label"))
    known = known.withColumn("__order", F.pmod(F.xxhash64("__id"), F.lit(1 << 20)))
    n = known.count()
    if n > fit_rows:
        known = known.where(F.col("__order") < int((1 << 20) * fit_rows / n))
    rows = (docs.select(F.col(f"`{id_col}`").alias("__id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
            .join(known, "__id").select("label", "text")
            .mapInArrow(_feature_rows, "label long, size array<long>, x array<float>"))
    got = rows.toArrow()
    if not got.num_rows:
        return fit_field(np.zeros((0, WIDTH)), np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64))
    size = got.column("size").combine_chunks()
    lines = np.concatenate([[0], np.cumsum(size.value_lengths().to_numpy())])
    x = got.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH).astype(float)
    return fit_field(x, size.flatten().to_numpy(), lines, (got.column("label").to_numpy() > 0).astype(np.int64))


def scored(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, with ``score``."""
    rest = [c for c in docs.columns if c not in (text_col, "score")]
    given = docs.select(*[F.col(f"`{c}`") for c in rest], F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("__text"))
    schema = given.select(*[F.col(f"`{c}`") for c in rest]).schema.add("score", "double")
    n, names = len(rest), schema.names

    def run(batches):
        tb.lean()
        for b in batches:
            score = np.zeros(b.num_rows)
            for r0, r1, data, offsets in tb.chunks(b.column(n)):
                score[r0:r1] = field.score(*line_features(data, offsets))
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(score)], names=names)

    return given.mapInArrow(run, schema)
