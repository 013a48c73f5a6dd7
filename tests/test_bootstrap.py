"""Replicates as arrays against the same weights taken row by row."""

import hashlib

import numpy as np
import pytest

from riskloom.operators import bootstrap as B

N_BOOT = 37


def drawn(keys):
    digest = [hashlib.md5(f"{k}|42|boot".encode()).hexdigest() for k in keys]
    a, b = (np.array([int(d[i: i + 8], 16) for d in digest]) for i in (0, 8))
    return B.weights(a, b, np.arange(1, N_BOOT + 1))


def brute_auc(score, y, w):
    total = 0.0
    for s, k in zip(score[y == 1], w[y == 1], strict=True):
        other, of = score[y == 0], w[y == 0]
        total += k * (of[other < s].sum() + of[other == s].sum() / 2)
    p, n = w[y == 1].sum(), w[y == 0].sum()
    return total / (p * n) if p and n else None


@pytest.fixture(scope="module")
def rows():
    """One score holds a third of all rows; one group has a single positive, one a single class."""
    rng = np.random.default_rng(8)
    out = []
    for i in range(900):
        g = "ab"[i % 2] if i < 860 else "cd"[i % 2]
        y = int(rng.random() < 0.3) if g in "ab" else int(i == 861 and g == "d")
        out.append((i, g, 0.5 if rng.random() < 0.34 else float(np.round(rng.normal() + y, 2)), y))
    return out + [(2000, "a", None, 1), (2001, "a", 0.1, None), (2002, "b", float("nan"), 0)]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "id long, g string, s double, y int").repartition(5)


def test_weights_are_poisson():
    w = drawn(range(4000))
    assert abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.02
    assert abs(np.corrcoef(w.T)[0, 1:]).max() < 0.08


@pytest.mark.parametrize("partitions", ["3", "40"])
def test_replicate_aucs(spark, rows, df, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r.g, r.rep): r.auc for r in B.replicate_aucs(df, "id", "s", "y", N_BOOT, group_cols=["g"]).collect()}
        band = sorted(B.roc_band_bootstrap(df, "id", "s", "y", n_boot=N_BOOT, grid_points=21).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    good = [r for r in rows if r[2] is not None and not np.isnan(r[2]) and r[3] is not None]
    for g in "abcd":
        mine = [r for r in good if r[1] == g]
        w = drawn([r[0] for r in mine])
        score, y = np.array([r[2] for r in mine]), np.array([r[3] for r in mine])
        for rep in range(N_BOOT):
            want, have = brute_auc(score, y, w[:, rep]), got[g, rep + 1]
            assert (want is None and have is None) or abs(want - have) < 1e-12
    w = drawn([r[0] for r in good])
    score, y = np.array([r[2] for r in good]), np.array([r[3] for r in good])
    curves = []
    for rep in range(N_BOOT):
        at = np.unique(score)[::-1]
        tpr = np.array([0.0] + [w[(score >= s) & (y == 1), rep].sum() for s in at]) / w[y == 1, rep].sum()
        fpr = np.array([0.0] + [w[(score >= s) & (y == 0), rep].sum() for s in at]) / w[y == 0, rep].sum()
        curve = np.interp(np.arange(21) / 20, fpr, tpr)
        curve[0] = 0
        curves.append(curve)
    for r, c in zip(band, np.array(curves).T, strict=True):
        assert np.allclose([r.tpr_lo, r.tpr_hi, r.tpr_mean], [np.quantile(c, 0.025), np.quantile(c, 0.975), c.mean()], atol=2e-6)


def test_fallback_only_where_delong_is_undefined(df):
    got = {r.g: r for r in B.auc_ci(df, "id", "s", "y", group_cols=["g"], n_boot=200).collect()}
    assert {g: r.method for g, r in got.items()} == {"a": "delong", "b": "delong", "c": "none", "d": "bootstrap"}
    assert got["c"].auc is None and got["c"].ci_lo is None
    assert 0 < got["d"].n_boot_used < 200 and got["d"].ci_lo <= got["d"].auc <= got["d"].ci_hi


def test_interp_grid_follows_numpy():
    x, y = np.array([0, 0, 3, 3, 7, 10]), np.array([0, 2, 2, 5, 6, 8])
    place, got = B.interp_grid(x, y, 10, 8, 100)
    assert place.tolist() == list(range(101)) and np.allclose(got, np.interp(place / 100, x / 10, y / 8))
