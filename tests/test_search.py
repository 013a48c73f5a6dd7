"""Validation search, group cross-validation, early stopping and feature vectors on small tables."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.plans import models as MD
from riskloom.plans import search as SE
from riskloom.session import path_exists


@pytest.fixture(scope="module")
def split(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(400):
        x, c = float(rng.normal()), "abc"[rng.integers(3)]
        y = int(rng.random() < 1 / (1 + np.exp(-(2 * x + (c == "b")))))
        rows.append((i, i // 3, y, x, c, ("train", "train", "val", "test")[i % 4]))
    rows.append((400, 999, 1, 0.0, "unseen", "test"))
    return spark.createDataFrame(rows, "row_id long, person long, y_30d int, x double, c string, split string").coalesce(1)


@pytest.fixture(scope="module")
def vectors(split):
    with SE.vectors(split, ["x"], ["c"]) as v:
        yield v


def test_first_level_is_dropped_and_unseen_is_zero(split):
    train = split.where("split = 'train'")
    feats = MD.fit_features(train, ["x"], ["c"], scale=False)
    assert MD.feature_names(feats, split, "features") == ["x", "c__ohe_c", "c__ohe_b"]
    got = {r.c: r.v[1:] for r in feats.transform(split).select("c", vector_to_array("features").alias("v")).collect()}
    assert got == {"a": [0.0, 0.0], "b": [0.0, 1.0], "c": [1.0, 0.0], "unseen": [0.0, 0.0]}


def test_one_level_leaves_no_column(split):
    one = split.withColumn("c", F.lit("only"))
    feats = MD.fit_features(one, ["x"], ["c"])
    assert MD.feature_names(feats, one) == ["x"]


def test_first_of_equal_configurations_wins(vectors):
    grid = ({"penalty": "l2", "C": 1.0, "n_tag": 0}, {"penalty": "l2", "C": 1.0, "n_tag": 1})
    fits = [lambda v, p=p: [(p, MD.logreg(v.n, C=p["C"], weight_col="balanced").fit(v.part("train")))] for p in reversed(grid)]
    best = SE.grid_select(vectors, grid, fits)
    assert best.params == grid[0] and best.tried[0][1] == best.tried[1][1] == best.auc > 0.6


def test_search_takes_the_highest_validation_auc(vectors):
    grid = SE.SHIFT_GRID
    best = SE.grid_select(vectors, grid, SE.logreg_fits(grid))
    assert best.auc == max(a for _, a in best.tried) and [p for p, _ in best.tried] == list(grid)


def test_fewer_trees_are_the_first_rounds(vectors):
    kw = {"max_depth": 2, "lr": 0.1, "subsample": 1.0, "weight_col": "boosted"}
    train, test = vectors.part("train"), vectors.part("test")
    long, short = MD.gbt(n_iter=6, **kw).fit(train), MD.gbt(n_iter=3, **kw).fit(train)
    cut = SE.first_trees(long, 3)
    assert cut.getNumTrees == 3
    a, b = ({r.row_id: r.p for r in SE.predicted(m, test, "m").collect()} for m in (cut, short))
    assert a == pytest.approx(b)


def test_boosting_stops_on_the_validation_rows(vectors):
    assert 1 <= SE.early_stop_val(vectors, limit=60, max_depth=3, lr=0.3).getNumTrees < 60


def test_weights(vectors):
    train = vectors.part("train")
    sums = {r.y: (r.b, r.s) for r in train.groupBy("y").agg(F.sum("balanced").alias("b"), F.sum("boosted").alias("s")).collect()}
    assert sums[0][0] == pytest.approx(sums[1][0]) == pytest.approx(vectors.n / 2) and sums[0][1] == pytest.approx(sums[1][1])


def test_native_codes_are_nominal(split):
    with SE.vectors(split, ["x"], ["c"], native=True) as v:
        attrs = v.rows.schema["features"].metadata["ml_attr"]["attrs"]
        assert [a["name"] for a in attrs["nominal"]] == ["c__idx"] and len(attrs["nominal"][0]["vals"]) == 4
        model = MD.gbt(max_depth=2, n_iter=2, weight_col="boosted", bins=v.bins).fit(v.part("train"))
        assert SE.predicted(model, v.part("test"), "m").where("p between 0 and 1").count() == v.part("test").count()


def test_group_folds_are_scored_by_the_others(split):
    got = SE.cv_auc(split.drop("split"), ["x"], ["c"], lambda v: MD.logreg(v.n, weight_col="balanced").fit(v.part("train")), group="person", k=3).collect()
    assert sorted(r.fold for r in got) == [0, 1, 2] and sum(r.n for r in got) == 401
    assert all(r.method == "delong" and r.ci_lo <= r.auc <= r.ci_hi and r.auc > 0.6 for r in got)


def test_top_coefficients(spark):
    coefs = spark.createDataFrame([(f"f{i}", float(i)) for i in range(9)], "feature string, coef double")
    top = {(r.feature, r.end) for r in MD.topk_coefs(coefs, 2).collect()}
    assert top == {("f0", "lowest"), ("f1", "lowest"), ("f8", "highest"), ("f7", "highest")}


def test_a_fit_has_few_tasks_however_many_partitions_its_rows_have(split, spark, monkeypatch):
    monkeypatch.setattr(MD, "TASK_ROWS", 1)
    most = MD.CORE_TASKS * spark.sparkContext.defaultParallelism
    many = split.repartition(most * 3)
    with SE.vectors(many, ["x"], ["c"]) as v:
        assert v.rows.rdd.getNumPartitions() <= most and v.rows.count() == 401
    assert MD.bounded(many, 401).rdd.getNumPartitions() == most

    class Fit:
        def fit(self, rows):
            self.tasks = rows.rdd.getNumPartitions()
            return MD.logreg(401, weight_col=None).fit(rows)
    seen = Fit()
    MD.fit(MD.prepare(many), ["x"], ["c"], seen)
    assert seen.tasks <= most


def test_a_logistic_fit_has_a_task_for_several_cores_and_vectors_no_lineage(split, spark, monkeypatch):
    monkeypatch.setattr(MD, "TASK_ROWS", 1)
    cores = spark.sparkContext.defaultParallelism
    seen = []
    fit = MD.LogisticRegression.fit
    monkeypatch.setattr(MD.LogisticRegression, "fit", lambda self, rows: seen.append(rows.rdd.getNumPartitions()) or fit(self, rows))
    many = split.repartition(cores * 3)
    with SE.vectors(many, ["x"], ["c"]) as v:
        assert v.rows.rdd.getNumPartitions() == cores
        assert "CheckpointRDD" in v.rows.rdd.toDebugString().decode() and "Exchange" not in v.rows._jdf.queryExecution().toString()
        SE.grid_select(v, SE.SHIFT_GRID, SE.logreg_fits(SE.SHIFT_GRID))
        SE.RECIPES["logreg_l2_base"].fit(v)
        stored = v.rows._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get()
        assert path_exists(spark, stored)
    assert not path_exists(spark, stored)
    MD.fit(MD.prepare(many), ["x"], ["c"], MD.logreg(401, weight_col=None))
    assert seen == [max(1, cores // MD.LOSS_CORES)] * 5


def test_boosting_has_a_task_a_core(split, spark, monkeypatch):
    monkeypatch.setattr(MD, "TASK_ROWS", 1)
    cores = spark.sparkContext.defaultParallelism
    with SE.vectors(split.repartition(cores * 3), ["x"], ["c"], native=True) as v:
        assert v.part("train", "val").rdd.getNumPartitions() == cores


def test_facts_score_each_row_once(spark):
    """The counts and every pass of the AUC walked the trees again."""
    from riskloom.plans.model_catalog import _facts
    scored = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def p(i):
        scored.add(1)
        return i / 40
    pred = spark.range(0, 40, 1, 2).select(F.lit("m").alias("model"), F.col("id").alias("row_id"), (F.col("id") % 3 == 0).cast("int").alias("y"), p("id").alias("p"))
    row = _facts(pred, n_trees=3).first()
    assert (row.model, row.n, row.n_pos, row.scores_valid, row.auc_valid, row.n_trees) == ("m", 40, 14, True, True, 3)
    assert scored.value == 40


def test_folds_share_one_table_of_vectors(split, spark, monkeypatch):
    """Each fold had its own pass for levels, scale and vectors; what it gets is as if it still had."""
    rare = split.drop("split").withColumn("fold", (F.col("person") % 3).cast("int")).withColumn("c", F.when(F.col("person") % 3 == 1, F.concat("c", F.lit("_1"))).otherwise(F.col("c")))
    rare = rare.withColumn("same", F.lit(0.1)).withColumn("d", F.when(F.col("row_id") % 7 > 0, "d").otherwise(None))
    with SE.fold_vectors(rare, ["x", "same"], ["c", "d"]) as of:
        for i in range(3):
            given = rare.withColumn("split", F.when(F.col("fold") == i, "test").otherwise("train"))
            with SE.vectors(given, ["x", "same"], ["c", "d"]) as old:
                new = of(i)
                assert (new.n, new.ratio, new.width) == (old.n, old.ratio, old.width)
                assert MD.feature_names(new.feats, given) == MD.feature_names(old.feats, given)
                a, b = ({r.row_id: (r.y, r.split, r.label, r.balanced, r.boosted, r.f) for r in v.rows.withColumn("f", vector_to_array("features")).collect()} for v in (new, old))
                assert a.keys() == b.keys() and all(a[x][:5] == b[x][:5] and a[x][5] == pytest.approx(b[x][5], rel=1e-9, abs=1e-12) for x in a)
    passes = []
    fit = MD.fit_features
    monkeypatch.setattr(MD, "fit_features", lambda *a, **b: passes.append(1) or fit(*a, **b))
    SE.cv_auc(split.drop("split"), ["x"], ["c"], SE.fit_logreg, group="person", k=3)
    assert not passes


def test_streamed_fit_finds_the_same_minimum(vectors, monkeypatch):
    """A fit kept all its training rows in memory and read them a hundred times."""
    from riskloom.plans import newton as NW
    in_memory = {c: MD.logreg(vectors.n, C=c, weight_col="balanced").setTol(1e-12).fit(vectors.part("train")) for c in (0.01, 1.0)}
    monkeypatch.setattr(NW, "STREAM_ROWS", 10)
    monkeypatch.setattr(NW, "BLOCK_ROWS", 64)
    monkeypatch.setattr(MD.LogisticRegression, "fit", lambda self, rows: pytest.fail("not streamed"))
    for c, model in in_memory.items():
        got = SE.fit_logreg(vectors, C=c)
        assert got.coefficients.toArray().tolist() == pytest.approx(model.coefficients.toArray().tolist(), abs=1e-6) and got.intercept == pytest.approx(model.intercept, abs=1e-6)
        a, b = ({r.row_id: r.p for r in SE.predicted(m, vectors.part("test"), "m").collect()} for m in (got, model))
        assert a == pytest.approx(b, abs=1e-6)


def test_streamed_fit_needs_no_package_on_the_executors():
    from pyspark import cloudpickle

    from riskloom.plans import newton as NW
    assert NW.__name__ in cloudpickle.list_registry_pickle_by_value()


def test_streamed_fit_leaves_what_has_no_minimum(vectors, monkeypatch):
    from riskloom.plans import newton as NW
    one = vectors.part("train").where("y = 1")
    assert NW.fit(MD.logreg(10, weight_col="balanced"), one, vectors.width) is None
    monkeypatch.setattr(NW, "STREAM_ROWS", 10)
    assert SE.fit_logreg(vectors, penalty="l1", C=0.1).getElasticNetParam() == 1.0


def test_packed_vectors_are_sparse_or_dense():
    import pyarrow as pa

    from riskloom.plans import newton as NW
    given = pa.array([{"type": 0, "size": 3, "indices": [2], "values": [5.0]}, {"type": 1, "size": None, "indices": None, "values": [1.0, 2.0, 3.0]},
                      {"type": 0, "size": 3, "indices": [], "values": []}, {"type": 0, "size": 3, "indices": [0, 1], "values": [7.0, 8.0]}],
                     pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))]))
    assert NW.dense(given, 3).tolist() == [[0, 0, 5], [1, 2, 3], [0, 0, 0], [7, 8, 0]]
    assert NW.dense(given.slice(1, 2), 3).tolist() == [[1, 2, 3], [0, 0, 0]]
