"""Catalogued queries: feature assembly, scaling, target-encoded and raw-code features, recipe runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions.hashing import sql_keyed_hash
from riskloom.functions.stats import r6 as sr6
from riskloom.operators import features as FE
from riskloom.plans import search as SE
from riskloom.plans.cohort_catalog import _COHORT, cohort_df
from riskloom.plans.feature_catalog import _slim_base_sql
from riskloom.plans.model_catalog import _TEST_SQL, split_cohort
from riskloom.plans.registry import query, r6
from riskloom.plans.split_catalog import _VR, _strat_sql
from riskloom.sources.fixtures import cte

_BASE = cte("encounters") + "," + _COHORT
_NUM3 = ("num_lab_procedures", "num_medications", "time_in_hospital")


@query("assemble_features", _BASE + """select c.encounter_id as row_id, c.number_inpatient, c.num_medications, c.race, c.a1cresult
from cohort c""")
def q_assemble_features(spark, sf):
    c = cohort_df(spark, sf, ["number_inpatient", "num_medications", "race", "a1cresult"])
    num = c.select("row_id", "number_inpatient", "num_medications")
    cat = c.select("row_id", "race", "a1cresult")
    return FE.assemble_features(num, cat, key="row_id")


@query("scale_std", _BASE + ", sd as (select " + ", ".join(f"stddev_pop(cast({c} as double)) as sd_{c}" for c in _NUM3)
       + " from cohort) select encounter_id as row_id, " + ", ".join(
           r6(f"cast({c} as double) / case when sd_{c} > 0 then sd_{c} else 1.0e0 end") + f" as {c}" for c in _NUM3)
       + " from cohort cross join sd")
def q_scale_std(spark, sf):
    c = cohort_df(spark, sf, list(_NUM3))
    s = FE.scale_std(c, list(_NUM3))
    return s.select("row_id", *[sr6(x).alias(x) for x in _NUM3])


def _features_te_sql() -> str:
    cols = FE.TE_COLUMNS
    h = sql_keyed_hash(["row_id"], 42, "kfold")
    parts = [_BASE, ", c as (select encounter_id as row_id, y_30d from cohort), ",
             _strat_sql("c", "row_id", "y_30d", "split", 0.15, _VR),
             ", raw as (select s2.row_id, s2.y_30d, s2.split, " + ", ".join(f"co.{c}" for c in cols)
             + " from s2 join cohort co on s2.row_id = co.encounter_id)",
             f", tr as (select *, cast((row_number() over (partition by y_30d order by {h}, row_id) - 1) % 5 as int) as fold "
             "from raw where split = 'train')",
             ", g as (select avg(y_30d * 1.0e0) as g from tr)",
             f", base as ({_slim_base_sql('cohort')})"]
    sel_tr, sel_rs, joins_tr, joins_rs = [], [], [], []
    for c in cols:
        parts.append(f", pf_{c} as (select {c} as k, fold, count(*) as cf, sum(y_30d * 1.0e0) as sf from tr where {c} is not null group by {c}, fold)"
                     f", po_{c} as (select k, fold, sum(cf) over (partition by k) - cf as co, sum(sf) over (partition by k) - sf as so from pf_{c})"
                     f", full_{c} as (select {c} as k, count(*) as n, sum(y_30d * 1.0e0) as s from tr where {c} is not null group by {c})")
        joins_tr.append(f"left join po_{c} on tr.{c} = po_{c}.k and tr.fold = po_{c}.fold")
        sel_tr.append(r6(f"(coalesce(po_{c}.so, 0) + g.g * 20.0e0) / (coalesce(po_{c}.co, 0) + 20.0e0)") + f" as {c}_te")
        joins_rs.append(f"left join full_{c} on r.{c} = full_{c}.k")
        sel_rs.append(r6(f"coalesce((full_{c}.s + g.g * 20.0e0) / (full_{c}.n + 20.0e0), g.g)") + f" as {c}_te")
    enc = (f", enc as (select tr.row_id, tr.split, {', '.join(sel_tr)} from tr cross join g {' '.join(joins_tr)} "
           f"union all select r.row_id, r.split, {', '.join(sel_rs)} from raw r cross join g {' '.join(joins_rs)} where r.split <> 'train')")
    nums = ", ".join(r6(f"cast(base.{c} as double)") + f" as {c}" for c in FE.BASE_NUMERIC)
    low = ", ".join(f"coalesce(cast(base.{c} as varchar), '?') as {c}" for c in FE.LOW_CATEGORICAL)
    return ("".join(parts) + enc + f"\nselect enc.row_id, {nums}, {low}, enc.split, "
            + ", ".join(f"enc.{c}_te" for c in cols) + " from enc join base on enc.row_id = base.encounter_id")


@query("features_te", _features_te_sql())
def q_features_te(spark, sf):
    t = FE.features_te(split_cohort(spark, sf))
    te = [f"{c}_te" for c in FE.TE_COLUMNS]
    return t.select("row_id", *[sr6(c).alias(c) for c in FE.BASE_NUMERIC], *FE.LOW_CATEGORICAL, "split", *[sr6(c).alias(c) for c in te])


@query("features_native_cat", _BASE + f", base as ({_slim_base_sql('cohort')})\nselect encounter_id as row_id, y_30d, "
       + ", ".join(r6(f"cast({c} as double)") + f" as {c}" for c in FE.BASE_NUMERIC) + ", "
       + ", ".join(f"coalesce(cast({c} as varchar), '?') as {c}" for c in FE.NATIVE_CATEGORICAL) + " from base")
def q_features_native_cat(spark, sf):
    x = FE.features_native_cat(cohort_df(spark, sf))
    return x.select(*[sr6(c).alias(c) if c in FE.BASE_NUMERIC else c for c in x.columns])


def _config_sql(*names: str) -> str:
    return _TEST_SQL + " union all ".join(f"select '{n}' as config, n as n_test, n_pos, true as auc_valid, true as scored_all from t" for n in names)


def _ran(spark, sf, names):
    """Facts of each recipe's run, and its metrics row."""
    cohort = split_cohort(spark, sf).persist()  # features read it several times, and each recipe again
    out = []
    try:
        for name in names:
            row, pred = SE.run_config(name, cohort)
            out.append(row.select("config", "n_test", "n_pos", (F.col("auc").between(0.0, 1.0) & (F.col("runtime_sec") > 0)).alias("auc_valid"),
                                  F.lit(pred.count() == row.first()["n_test"]).alias("scored_all"), "auc"))
    finally:
        cohort.unpersist()
    return out


@query("run_config", _config_sql("logreg_l2_bucketed"))
def q_run_config(spark, sf):
    return _ran(spark, sf, ["logreg_l2_bucketed"])[0].drop("auc")


@query("encoding_ablation", "select *, config <> 'logreg_l2_base' as compared from (" + _config_sql("logreg_l2_base", "logreg_target_enc") + ") x")
def q_encoding_ablation(spark, sf):
    """The same learner on the same rows: codes in buckets against target-encoded codes, with the difference in AUC."""
    base, encoded = _ran(spark, sf, ["logreg_l2_base", "logreg_target_enc"])
    delta = F.col("auc") - F.lit(base.first()["auc"])
    both = base.unionByName(encoded).withColumn("delta", F.when(F.col("config") != "logreg_l2_base", delta))
    return both.select("config", "n_test", "n_pos", "auc_valid", "scored_all", F.coalesce(F.col("delta").between(-1.0, 1.0), F.lit(False)).alias("compared"))
