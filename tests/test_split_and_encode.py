"""Split / fold / sample properties and target-encoding semantics."""

import numpy as np
from pyspark.sql import functions as F

from conftest import SF001
from riskloom.operators import encode as EN
from riskloom.operators import split as S
from riskloom.plans.cohort_catalog import cohort_df
from riskloom.sources.tables import read_table


def test_split_disjoint_exhaustive_stable(spark):
    c = cohort_df(spark, SF001, []).select("row_id", "y_30d")
    a = {r.row_id: r.split for r in S.split_stratified(c, "row_id", "y_30d").collect()}
    b = {r.row_id: r.split for r in S.split_stratified(c.repartition(7), "row_id", "y_30d").collect()}
    assert a == b
    n = c.count()
    assert len(a) == n
    counts = {k: sum(1 for v in a.values() if v == k) for k in ("train", "val", "test")}
    assert abs(counts["test"] - 0.15 * n) <= 2 and abs(counts["val"] - 0.15 * n) <= 2


def test_group_split_and_group_folds_never_straddle(spark):
    ev = read_table(spark, SF001, "events").select("event_id", "user_id",
                                                   (F.col("event_type") == "purchase").cast("int").alias("y"))
    g = S.split_group(ev, "user_id")
    assert g.groupBy("user_id").agg(F.countDistinct("split").alias("k")).where("k > 1").count() == 0
    f = S.kfold_stratified_group(ev, "user_id", "y", 5)
    assert f.groupBy("user_id").agg(F.countDistinct("fold").alias("k")).where("k > 1").count() == 0
    assert f.count() == ev.count()


def test_sample_exact_size(spark):
    c = cohort_df(spark, SF001, []).select("row_id", "y_30d")
    s = S.sample_stratified_n(c, "row_id", "y_30d", 300)
    assert s.count() == 300
    assert s.select("row_id").distinct().count() == 300
    allk = S.sample_stratified_n(c, "row_id", "y_30d", 10 ** 6, keep_all_if_larger=True)
    assert allk.count() == c.count()


def test_chunks_contiguous(spark):
    o = read_table(spark, SF001, "orders").select(F.col("o_orderkey").alias("row_id"))
    ch = S.chunk_assign(o, "row_id", 7).collect()
    by = sorted(ch, key=lambda r: r.row_id)
    assert [r.chunk_id for r in by] == sorted(r.chunk_id for r in by)
    sizes = [sum(1 for r in ch if r.chunk_id == k) for k in range(7)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(ch)


def test_oof_own_label_only_moves_prior(spark):
    rows = [(i, "a" if i % 2 else "b", int(i % 5 == 0), i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, c string, y int, fold int")
    base = {r.id: r.c_te for r in EN.target_oof(df, "c", "y", "fold").collect()}
    flipped = df.withColumn("y", F.when(F.col("id") == 10, 1 - F.col("y")).otherwise(F.col("y")))
    after = {r.id: r.c_te for r in EN.target_oof(flipped, "c", "y", "fold").collect()}
    # the flipped row's own encoding changes only through the global prior (weight 20)
    n_oof = sum(1 for r in rows if r[1] == rows[10][1] and r[3] != rows[10][3])
    delta_prior = (1 if rows[10][2] == 0 else -1) / 60.0
    assert abs((after[10] - base[10]) - delta_prior * 20.0 / (n_oof + 20.0)) < 1e-12


def test_unseen_category_gets_prior(spark):
    tr = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1)], "c string, y int")
    ap = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    got = {r.c: r.c_te for r in EN.target_mean_smoothed(tr, ap, "c", "y").collect()}
    g = 2 / 3
    assert abs(got["z"] - g) < 1e-12 and abs(got[None] - g) < 1e-12
    assert abs(got["a"] - (1 + g * 20) / 22) < 1e-12


def test_first_per_entity_hot_key(spark):
    """One entity holds a third of all rows: result is still exact, and the plan
    combines map-side (partial aggregate before the exchange), not a window."""
    from riskloom.operators.cohort import first_per_entity
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 997).alias("e"),
        ((F.col("id") * 7919) % 30011).alias("o"), F.col("id").alias("payload"))
    out = first_per_entity(df, "e", ["o"])
    got = {r.e: (r.o, r.payload) for r in out.collect()}
    want = {}
    for r in df.collect():
        if r.e not in want or r.o < want[r.e][0]:
            want[r.e] = (r.o, r.payload)
    assert got == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_first_per_entity_makes_other_columns_for_first_rows_only(spark):
    """A derived frame's wide columns were made, sorted and packed for every row."""
    from riskloom.operators.cohort import first_per_entity
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def wide(i):
        made.add(1)
        return f"w{i}"
    df = spark.range(0, 2000, 1, 3).select((F.col("id") % 20).alias("e"), F.col("id").alias("o"), wide("id").alias("w"))
    got = {r.e: (r.o, r.w) for r in first_per_entity(df, "e", ["o"]).collect()}
    assert got == {i: (i, f"w{i}") for i in range(20)}
    assert made.value == 20


def test_first_per_entity_null_and_equal_keys(spark):
    from riskloom.operators.cohort import first_per_entity
    rng = np.random.default_rng(3)

    def some(n):
        i = int(rng.integers(n + 1))
        return None if i == n else i
    rows = [(some(6), some(4), some(3), f"p{some(5)}") for _ in range(400)] + [(99, 1, 2, "twice")] * 2 + [(98, 3, 1, "b"), (98, 3, 1, "a"), (97, 0, None, "c")]
    df = spark.createDataFrame(rows, "e int, o int, q int, p string").repartition(5)
    less = lambda v: (v is not None, v if v is not None else 0)
    for order in (["o"], ["q", "o"]):
        names = order + [c for c in ("o", "q", "p") if c not in order]
        want = {}
        for r in df.collect():
            t = tuple(less(r[c]) for c in names)
            if r.e not in want or t < want[r.e][0]:
                want[r.e] = (t, (r.o, r.q, r.p))
        got = first_per_entity(df, "e", order)
        assert got.columns == ["e", "o", "q", "p"]
        found = got.collect()
        assert {r.e: (r.o, r.q, r.p) for r in found} == {e: v for e, (_, v) in want.items()} and len(found) == len(want)


def test_group_folds_are_balanced(spark):
    rng = np.random.default_rng(11)
    rows, at = [], 0
    for g in range(300):
        size, rate = int(rng.pareto(1.2) * 3) + 1, rng.random() < 0.3
        size = min(size, 400)
        for _ in range(size):
            rows.append((at, g, int(rate and rng.random() < 0.5)))
            at += 1
    rows += [(at + i, None, i % 4 == 0) for i in range(200)]
    df = spark.createDataFrame([(a, b, int(c)) for a, b, c in rows], "id long, g long, y int")
    for key in ("id", None):
        got = S.kfold_stratified_group(df, "g", "y", 5, key=key).collect()
        assert len(got) == len(rows)
        fold = {}
        for r in got:
            if r.g is not None:
                assert fold.setdefault(r.g, r.fold) == r.fold
        alone = [sum(r.fold == f for r in got if r.g is None) for f in range(5)]
        assert max(alone) - min(alone) <= 2  # one for each label
        by_group = {}
        for _, g, y in rows:
            if g is not None:
                n, p = by_group.get(g, (0, 0))
                by_group[g] = (n + 1, p + y)
        pos = [sum(by_group[g][1] for g, f in fold.items() if f == k) for k in range(5)]
        assert max(pos) - min(pos) <= 2 * max(p for _, p in by_group.values())
        for some in {p for _, p in by_group.values()}:
            of = [sum(by_group[g][0] for g, f in fold.items() if f == k and by_group[g][1] == some) for k in range(5)]
            assert max(of) - min(of) <= 2 * max(n for n, p in by_group.values() if p == some)
