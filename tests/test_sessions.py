"""Session states, matrices over several axes, and the sinks."""

import json
import os

import pytest
from pyspark.sql import functions as F

from riskloom.operators import leaderboard as LB
from riskloom.sources import files as FS

STATE = {"scope_slug": "risk", "axes": {"size": ["s", "m"], "task": ["a", "b", "c"]}, "results_history": [
    {"id": "x", "axes": {"size": "s", "task": "a"}, "status": "complete", "metric_value": 0.7},
    {"id": "y", "axes": {"size": "m", "task": "a"}, "status": "complete", "metric_value": 0.7},
    {"id": "z", "axes": {"size": "m", "task": "b"}, "status": "failed", "metric_value": 0.9},
    {"id": "w", "axes": {"size": "m", "task": "b"}, "status": "complete"}],
    "candidate_queue": [{"id": "q", "status": "pending", "params": {"lr": "0.1"}}],
    "hpo_runs": [{"id": "h", "params": {"lr": "0.1", "depth": "4"}, "metrics": {"auc": 0.71}}]}


@pytest.fixture()
def states(scratch):
    for name, text in (("good", json.dumps(STATE, indent=1)), ("bare", '{"results_history": []}'), ("broken", '{"axes": {"size": [')):
        with open(os.path.join(scratch, f"{name}.json"), "w") as f:
            f.write(text)
    return scratch


def test_session_tables(spark, states):
    t = FS.scan_session_tables(spark, states, scope="other")
    files = {r.file.rsplit("/", 1)[1]: (r.readable, r.scope_ok) for r in t["files"].collect()}
    assert files["good.json"] == (True, False) and files["bare.json"] == (True, True) and files["broken.json"][0] is False
    assert [(r.axis_pos, r.axis, r.value_pos, r.value) for r in t["axes"].orderBy("axis_pos", "value_pos").collect()] == [
        (0, "size", 0, "s"), (0, "size", 1, "m"), (1, "task", 0, "a"), (1, "task", 1, "b"), (1, "task", 2, "c")]
    assert [r.id for r in t["results"].orderBy("seq").collect()] == ["x", "y", "z", "w"]
    assert [(r.id, r.params) for r in t["queue"].collect()] == [("q", {"lr": "0.1"})]
    assert {(r.kind, r.name, r.value) for r in t["hpo"].collect()} == {("param", "lr", "0.1"), ("param", "depth", "4"), ("metric", "auc", "0.71")}


def test_first_existing(spark, states):
    assert FS.first_existing(spark, f"{states}/no.json", f"{states}/good.json").endswith("good.json")
    with pytest.raises(FileNotFoundError, match="no.json"):
        FS.first_existing(spark, f"{states}/no.json")


@pytest.mark.parametrize(("declared", "want"), [(None, ["task"]), ("size", ["size"]), ("absent", ["task"]), (["size", "task", "no"], ["size", "task"]), (["no"], [None])])
def test_target_axes(declared, want):
    assert LB.target_axes(STATE["axes"], declared) == want


def test_axis_sections(spark, states):
    runs = FS.scan_session_state(spark, os.path.join(states, "good.json"))
    got = {(r.target_value, r.value): (r.best, r.status, r.is_winner) for r in LB.axis_sections(runs, STATE["axes"]).collect()}
    assert got == {("a", "s"): (0.7, "complete", True), ("a", "m"): (0.7, "complete", True), ("b", "s"): (None, "deferred", False),
                   ("b", "m"): (None, "deferred", False), ("c", "s"): (None, "deferred", False), ("c", "m"): (None, "deferred", False)}
    alone = LB.axis_sections(runs, {"size": ["s", "m"]}).collect()
    assert [(r.target_axis, r.target_value, r.best) for r in alone] == [("", None, 0.7)] * 2


def test_section_winner_in_axis_order(spark):
    cells = spark.createDataFrame([("z", "t", 0.7, 0), ("a", "t", 0.7, 1), ("b", "t", None, 2)], "axis string, target string, best double, place int")
    assert LB.section_winner(cells, "axis", "target", position="place").first().winner == "z"
    assert LB.section_winner(cells, "axis", "target").first().winner == "a"


def test_sinks_come_back(spark, scratch):
    df = spark.createDataFrame([(1, 'a "quoted", text', 0.5), (2, None, None)], "row_id long, note string, p double")
    FS.sink_csv(df, f"{scratch}/csv")
    back = spark.read.option("header", True).option("escape", '"').schema(df.schema).csv(f"{scratch}/csv")
    assert sorted(map(tuple, back.collect()), key=lambda r: r[0])[1] == (2, None, None) and back.count() == 2
    FS.sink_json(df, f"{scratch}/json")
    assert {r.note for r in spark.read.schema(df.schema).json(f"{scratch}/json").collect()} == {'a "quoted", text', None}
    FS.sink_split_ids(df.select("row_id", F.lit(1).alias("y_30d"), F.lit("test").alias("split")), f"{scratch}/ids")
    assert FS.scan_id_list(spark, f"{scratch}/ids").where("split = 'test'").count() == 2


def test_scan_chunks_csv(spark, scratch):
    os.makedirs(f"{scratch}/chunks")
    for k in range(2):
        with open(f"{scratch}/chunks/c{k}.csv", "w") as f:
            f.write('parsed_p,row_id,prompt_format,response\n' + f'0.{k + 1},{k},natural,"line one\nline, two"\n')
    got = sorted(FS.scan_chunks(spark, f"{scratch}/chunks", "csv").collect(), key=lambda r: r.row_id)
    assert [(r.row_id, r.parsed_p, r.response) for r in got] == [(0, 0.1, "line one\nline, two"), (1, 0.2, "line one\nline, two")]
    assert got[0].file.endswith("c0.csv")
