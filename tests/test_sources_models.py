"""File sources, bootstrap interval, model gate and a slice of the oracle catalogue."""

import json
import os

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF001
from riskloom.operators import bootstrap as B
from riskloom.operators import cohort as C
from riskloom.operators import features as FE
from riskloom.operators import metrics as M
from riskloom.operators import split as S
from riskloom.plans import models as MD
from riskloom.sources import files as FS
from riskloom.sources.fixtures import view
from riskloom.sources.tables import DRIVER_TABLES


def test_scan_encounters_keeps_codes_and_tokens(spark, scratch):
    names = [f.name for f in FS.encounter_schema().fields][::-1]  # bound by name, not by place
    vals = {n: "No" for n in names}
    vals.update(encounter_id="1", patient_nbr="9", race="?", gender="Female", age="[70-80)", weight="?",
                admission_type_id="1", discharge_disposition_id="11", admission_source_id="7",
                time_in_hospital="3", payer_code="?", medical_specialty="?", num_lab_procedures="40",
                num_procedures="1", num_medications="10", number_outpatient="0", number_emergency="0",
                number_inpatient="2", number_diagnoses="9", diag_1="250.83", diag_2="V58", diag_3="",
                max_glu_serum="None", A1Cresult=">7", change="Ch", diabetesMed="Yes", readmitted="<30")
    p = os.path.join(scratch, "enc.csv")
    with open(p, "w") as f:
        f.write(",".join(names) + "\n" + ",".join(vals[n] for n in names) + "\n")
    r = FS.scan_encounters(spark, p).first()
    assert r.diag_1 == "250.83" and r.diag_2 == "V58" and r.diag_3 is None
    assert r.max_glu_serum == "None" and r.race == "?" and r.glyburide_metformin == "No"


def test_scan_metrics_and_run_text(spark, scratch):
    for i, (cfg, auc) in enumerate([("lr", 0.69), ("gbt", 0.70)]):
        d = os.path.join(scratch, "runs", f"iter-{i + 1}_{cfg}")
        os.makedirs(d)
        with open(os.path.join(d, "metrics.json"), "w") as f:
            json.dump({"config": cfg, "auc": auc, "ci_lo": auc - 0.02, "ci_hi": auc + 0.02,
                       "runtime_sec": 1.5, "n_test": 100, "extra": {"k": "v"}}, f, indent=2)
        with open(os.path.join(d, "summary.md"), "w") as f:
            f.write("# Run\n\n**Headline metric (test):** AUC 0.7\n  Metric: 0.70\n" + ("status | done\n" if i else ""))
    m = FS.scan_metrics_json(spark, os.path.join(scratch, "runs", "*", "metrics.json"))
    assert sorted(r.config for r in m.collect()) == ["gbt", "lr"]
    t = {r.iter: r for r in FS.scan_run_text(spark, os.path.join(scratch, "runs", "*", "summary.md")).collect()}
    assert t[1].candidate == "lr" and t[1].metric == "0.70" and t[1].status == "—" and t[2].status == "done"


def test_scan_session_state(spark, scratch):
    p = os.path.join(scratch, "state.json")
    with open(p, "w") as f:
        json.dump({"axes": {"phase": ["a", "b"]}, "results_history": [
            {"id": "x", "axes": {"phase": "a", "cohort": "c1"}, "status": "complete", "metric_value": 0.7},
            {"id": "y", "axes": {"phase": "a", "cohort": "c2"}, "status": "failed"}]}, f, indent=2)
    rows = FS.scan_session_state(spark, p).orderBy("seq").collect()
    assert [r.id for r in rows] == ["x", "y"] and rows[0].axes["cohort"] == "c1"


def test_bootstrap_ci_brackets_point(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet").select(
        "event_id", "value", (F.col("event_type") == "purchase").cast("int").alias("y"))
    r = B.auc_bootstrap_ci(ev, "event_id", "value", "y", n_boot=100).first()
    d = M.auc_delong(ev, [], "value", "y").first()
    assert r.ci_lo <= r.auc <= r.ci_hi and r.n_boot_used == 100
    assert abs(r.ci_lo - d.ci_lo) < 0.02 and abs(r.ci_hi - d.ci_hi) < 0.02


def test_model_gate_all_encounters_group_split(spark, scratch):
    """Keep all encounters (no dedupe) -> group split by patient -> logistic; AUC > 0.6."""
    enc = C.clean_cohort(view(spark, SF001, "encounters"), dedupe=False)
    slim = FE.features_slim(enc).join(enc.select("row_id", "patient_nbr"), "row_id")
    s = S.split_group(slim, "patient_nbr")
    train = MD.prepare(s.where("split = 'train'"))
    m = MD.fit(train, list(FE.SLIM_NUMERIC), list(FE.SLIM_CATEGORICAL), MD.logreg(train.count(), C=1.0, penalty="l2"))
    pred = MD.predict_proba(m, s.where("split = 'test'"), model_name="lr")
    auc = MD.verify_roundtrip(spark, pred, os.path.join(scratch, "pred"))
    assert auc > 0.6
    assert MD.load_predictions(spark, os.path.join(scratch, "pred"), ["missing", "lr"]).count() == pred.count()


def test_catalogue_slice_matches_duckdb(spark):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    qs, ora = E.queries(), E.oracle_sql()
    assert set(ora) <= set(qs)
    for name in ["rate_wilson", "auc_delong_ci", "split_stratified", "parse_prob", "icd9_bucket", "peer_delta"]:
        s = sorted([tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in
                   qs[name](spark, SF001).select(*sorted(qs[name](spark, SF001).columns)).collect()], key=repr)
        cur = con.execute(ora[name])
        cols = [d[0] for d in cur.description]
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        d = sorted([tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in cur.fetchall()], key=repr)
        assert s == d, name


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns == ["lang", "n", "k", "rate", "ci_lo", "ci_hi"]


def test_persist_model_roundtrip(spark, scratch):
    from pyspark.ml import PipelineModel
    df = spark.createDataFrame([(i, float(i % 7), "a" if i % 3 else "b", int(i % 5 == 0)) for i in range(200)],
                               "row_id long, x double, c string, y_30d int")
    tr = MD.prepare(df, balanced=False)
    m = MD.fit(tr, ["x"], ["c"], MD.logreg(tr.count(), C=1.0, weight_col=None))
    p = os.path.join(scratch, "model")
    MD.persist_model(m, p)
    back = PipelineModel.load(p)
    a = sorted(r.p for r in MD.predict_proba(m, df).collect())
    b = sorted(r.p for r in MD.predict_proba(back, df).collect())
    assert a == b


def test_roc_band_shape(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet").select(
        "event_id", "value", (F.col("event_type") == "purchase").cast("int").alias("y"))
    band = sorted(B.roc_band_bootstrap(ev, "event_id", "value", "y", n_boot=40).collect(), key=lambda r: r.fpr)
    assert len(band) == 101 and band[0].fpr == 0.0 and band[-1].fpr == 1.0
    assert band[0].tpr_mean == 0.0 and abs(band[-1].tpr_mean - 1.0) < 1e-9
    assert all(r.tpr_lo <= r.tpr_mean + 1e-9 <= r.tpr_hi + 2e-9 for r in band)
    assert all(a.tpr_mean <= b.tpr_mean + 1e-9 for a, b in zip(band, band[1:]))
