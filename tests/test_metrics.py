"""AUC / DeLong / ROC against brute force, invariances, bucket monotonicity."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import metrics as M
from riskloom.operators.ranking import hash_rank, order_rank, prefix_sums, with_range_bucket

Z = 1.959963984540054


def brute_delong(y, s):
    pos, neg = s[y == 1], s[y == 0]
    psi = lambda a, b: (a > b) + 0.5 * (a == b)
    v10 = np.array([psi(p, neg).mean() for p in pos])
    v01 = np.array([psi(pos, n).mean() for n in neg])
    auc = v10.mean()
    var = v10.var(ddof=1) / len(pos) + v01.var(ddof=1) / len(neg)
    return auc, max(auc - Z * var ** 0.5, 0), min(auc + Z * var ** 0.5, 1)


@pytest.mark.parametrize("levels", [5, 50, 0])
def test_delong_matches_brute_force(spark, levels):
    rng = np.random.default_rng(levels)
    n = 600
    y = (rng.random(n) < 0.3).astype(int)
    s = rng.normal(size=n) + 0.8 * y
    if levels:
        s = np.round(s * levels / 4) / levels  # many ties
    df = spark.createDataFrame([(i, float(a), int(b)) for i, (a, b) in enumerate(zip(s, y))], "id long, s double, y int")
    r = M.auc_delong(df, [], "s", "y", round_digits=False).first()
    auc, lo, hi = brute_delong(y, s)
    assert abs(r.auc - auc) < 1e-9 and abs(r.ci_lo - lo) < 1e-9 and abs(r.ci_hi - hi) < 1e-9


def test_auc_invariances(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(v), int(rng.random() < 0.4)) for i, v in enumerate(rng.normal(size=400).round(1))]
    df = spark.createDataFrame(rows, "id long, s double, y int")
    a = M.auc_exact(df, [], "s", "y", round_digits=False).first().auc
    b = M.auc_exact(df.withColumn("s2", -F.col("s")), [], "s2", "y", round_digits=False).first().auc
    c = M.auc_exact(df.withColumn("s3", F.exp("s") * 3 + 1), [], "s3", "y", round_digits=False).first().auc
    assert abs(a + b - 1) < 1e-12 and abs(a - c) < 1e-12


def test_grouped_auc_equals_separate(spark):
    rng = np.random.default_rng(2)
    rows = [(i, ["a", "b", "c"][i % 3], float(rng.integers(0, 20)), int(rng.random() < 0.3)) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, g string, s double, y int")
    grouped = {r.g: r.auc for r in M.auc_exact(df, ["g"], "s", "y").collect()}
    for g in "abc":
        single = M.auc_exact(df.where(F.col("g") == g), [], "s", "y").first().auc
        assert grouped[g] == single


def test_degenerate_group_has_no_interval(spark):
    df = spark.createDataFrame([(1, 0.2, 1), (2, 0.1, 0), (3, 0.3, 0)], "id long, s double, y int")
    r = M.auc_delong(df, [], "s", "y").first()
    assert r.auc == 0.5 and r.ci_lo is None and r.ci_hi is None


def test_roc_endpoints(spark):
    rows = [(i, float(i % 7), int(i % 3 == 0)) for i in range(210)]
    roc = M.roc_curve(spark.createDataFrame(rows, "id long, s double, y int"), [], "s", "y").orderBy("threshold").collect()
    assert roc[0].tpr == 1.0 and roc[0].fpr == 1.0
    assert all(a.tpr >= b.tpr and a.fpr >= b.fpr for a, b in zip(roc, roc[1:]))


@pytest.mark.parametrize("kind", ["wide", "ids", "steep", "ties"])
def test_range_buckets_rise_and_fill(spark, kind):
    rng = np.random.default_rng(3)
    vals = {"wide": list(rng.normal(scale=1e3, size=3000)) + [0.0, -0.0, 5e-324, 1e308, -1e308, float("inf"), float("-inf"), 4.0 - 1e-15],
            "ids": list(10 ** 12 + np.arange(6000.0)), "steep": list(np.exp(rng.normal(scale=30, size=6000))),
            "ties": [0.5] * 3000 + list(rng.random(3000))}[kind]
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    rows = sorted(with_range_bucket(df, "v", "b").collect(), key=lambda r: r.v)
    assert all(a.b <= b.b for a, b in zip(rows, rows[1:], strict=False))
    apart = {}
    for r in rows:
        apart.setdefault(r.b, set()).add(r.v)
    assert max(map(len, apart.values())) <= 6000 / 256 * 2 and len(apart) > 1000


def test_range_buckets_of_nothing_and_of_nulls(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (1.0,)], "v double")
    got = {str(r.v): r.b for r in with_range_bucket(df, "v", "b").collect()}
    assert got["None"] == got["nan"] > got["1.0"]
    none = df.where("v = 7")
    assert order_rank(none, [], "v").count() == 0


def test_rows_cross_the_network_once(spark):
    """With broadcasts off, ranking exchanges the rows once; the rest are partial sums."""
    rows = [(i, None if i % 7 == 0 else i % 3, (i * 7919) % 4093 / 7.0, (i * 2654435761) % 2 ** 32) for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, g int, v double, h long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for out in (hash_rank(df, ["g"], "h", ["id"]), prefix_sums(df.withColumn("n", F.lit(1)), ["g"], "v", ["n"])):
            plan = out._jdf.queryExecution().executedPlan().toString()
            lines = plan.splitlines()
            whole = [b for a, b in zip(lines, lines[1:], strict=False) if "Exchange hashpartitioning" in a and "id#" in b]
            assert len(whole) == 1  # every other exchange carries sums of buckets
        ranks = {}
        for r in hash_rank(df, ["g"], "h", ["id"]).collect():
            ranks.setdefault(r.g, []).append((r.h, r.id, r._rank, r._n))
        for of in ranks.values():
            assert [x[2] for x in sorted(of)] == list(range(1, len(of) + 1)) and {x[3] for x in of} == {len(of)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_order_rank_is_dense_and_partition_independent(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 10007).alias("k"))
    r1 = {r.k: r._rank for r in order_rank(df, [], "k").collect()}
    r2 = {r.k: r._rank for r in order_rank(df.repartition(13), [], "k").collect()}
    assert r1 == r2
    assert sorted(r1.values()) == list(range(1, 5001))
    ks = sorted(r1)
    assert [r1[k] for k in ks] == list(range(1, 5001))


def test_auc_plan_is_bucket_partitioned(spark):
    """The data-sized window/exchange is keyed by the order bucket; the only
    window without a partition key runs over the per-bucket totals."""
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, float(v), int(rng.random() < 0.3)) for i, v in enumerate(rng.normal(size=2000))],
                               "id long, s double, y int")
    out = M.auc_delong(df, [], "s", "y")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_qb" in plan


def test_smd_of_a_null_numeric_skips_the_row(spark):
    from riskloom.operators import shift
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", None), (3, "a", 3.0), (4, "b", 6.0), (5, "b", 8.0), (6, "b", None)],
                               "row_id long, g string, x double")
    sparse = shift.smd_sparse(shift.unpivot(df, "row_id", ["x"]), df.select("row_id", "g"), "row_id", "g", "a", "b", ["x"]).collect()
    assert sparse == shift.smd_dense(df, ["x"], "g", "a", "b").collect()
    assert (sparse[0]["mean_a"], sparse[0]["mean_b"]) == (2.0, 7.0)


def test_smd_of_an_absent_onehot_level_counts_zero(spark):
    from riskloom.operators import shift
    groups = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "b")], "row_id long, g string")
    long = spark.createDataFrame([(1, "c_x", 1.0), (3, "c_x", 1.0), (4, "c_x", 1.0)], "row_id long, feature string, value double")
    row = shift.smd_sparse(long, groups, "row_id", "g", "a", "b", ["n"]).first()
    assert (row["mean_a"], row["mean_b"], row["std_all"]) == (0.5, 1.0, 0.5)
