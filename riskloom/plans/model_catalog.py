"""Catalogued model jobs.

A fit has no SQL form. Each query therefore returns what SQL can say about its
result (rows, labels, levels, splits, folds) beside checks of the rest: scores in range,
the choice in its grid, trees below their limit. Scores and coefficients themselves come
from the functions of ``plans.search`` and ``plans.models``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.hashing import sql_keyed_hash
from riskloom.operators import cohort as C
from riskloom.operators import features as FE
from riskloom.operators import metrics as M
from riskloom.operators import split as S
from riskloom.plans import models as MD
from riskloom.plans import search as SE
from riskloom.plans.cohort_catalog import _COHORT, cohort_df
from riskloom.plans.feature_catalog import _slim_base_sql
from riskloom.plans.registry import query
from riskloom.plans.split_catalog import _VR, _strat_sql
from riskloom.sources.fixtures import cte, view

_BASE = cte("encounters") + "," + _COHORT
_NUM = list(FE.SLIM_NUMERIC)
_CAT = [*FE.SLIM_CATEGORICAL, *FE.ACTIVE_DRUGS]
_SPLIT_SQL = _BASE + ", c as (select encounter_id as row_id, y_30d from cohort), " + _strat_sql("c", "row_id", "y_30d", "split", 0.15, _VR)
_TEST_SQL = _SPLIT_SQL + ", t as (select count(*)::BIGINT as n, sum(y_30d)::BIGINT as n_pos from s2 where split = 'test')\n"


def split_cohort(spark, sf) -> DataFrame:
    return S.split_stratified(cohort_df(spark, sf), "row_id", "y_30d")


def _slim(spark, sf):
    df, numeric, categorical, _ = SE.feature_frame("slim", split_cohort(spark, sf))
    return df, numeric, categorical


def _valid(p="p"):
    return F.col(p).between(0.0, 1.0)


def _kept(spark, frame: DataFrame) -> DataFrame:
    """A few rows as a frame that no longer needs its inputs."""
    return spark.createDataFrame(frame.collect(), frame.schema)


def _facts(pred: DataFrame, **more) -> DataFrame:
    """One row, kept: model, n, n_pos, whether all scores and the AUC are in range, and constants."""
    scored = pred.persist()  # the counts and each pass of the AUC would score again
    try:
        auc = M.auc_exact(scored, ["model"], "p", "y").select("model", "auc")
        rows = scored.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.sum("y").cast("long").alias("n_pos"), F.min(_valid()).alias("scores_valid"))
        return _kept(pred.sparkSession, rows.join(auc, "model").select("model", "n", "n_pos", "scores_valid", F.col("auc").between(0.0, 1.0).alias("auc_valid"),
                                                                       *[F.lit(v).alias(k) for k, v in more.items()]))
    finally:
        scored.unpersist()


@query("fit_predict", _SPLIT_SQL + "\nselect 'logreg' as model, row_id, y_30d as y, true as p_valid from s2 where split = 'test'")
def q_fit_predict(spark, sf):
    """The logistic model of the study's grid with the best validation AUC: P(y = 1) of every test row."""
    from riskloom.session import cut_lineage
    with SE.vectors(*_slim(spark, sf)) as v:
        best = SE.grid_select(v, SE.LOGREG_GRID, SE.logreg_fits())
        return cut_lineage(SE.predicted(best.model, v.part("test"), "logreg").select("model", "row_id", "y", _valid().alias("p_valid")))


_LEVELS_SQL = " union all ".join(f"select '{c}' as var, coalesce(cast({c} as varchar), '?') as lvl from tr" for c in _CAT)


@query("coef_table", _SPLIT_SQL + f""", slim as ({_slim_base_sql('cohort')}),
tr as (select slim.* from slim join s2 on slim.encounter_id = s2.row_id where s2.split = 'train'),
lv as (select distinct var, lvl from ({_LEVELS_SQL}) x),
f as (select var, min(lvl) as first_lvl from lv group by var)
select lv.var || '__ohe_' || lv.lvl as feature, true as coef_valid from lv join f on lv.var = f.var where lv.lvl <> f.first_lvl
union all """ + " union all ".join(f"select '{c}', true" for c in _NUM))
def q_coef_table(spark, sf):
    """One coefficient for each numeric column and each level but the first, named."""
    df, numeric, categorical = _slim(spark, sf)
    taught = df.where("split = 'train'").persist()  # counted, weighted and fitted
    try:
        train = MD.prepare(taught)
        m = MD.fit(train, numeric, categorical, MD.logreg(taught.count(), C=1.0))
        return MD.coef_table(m, train).select("feature", (~F.isnan("coef")).alias("coef_valid"))
    finally:
        taught.unpersist()


@query("shift_eval", _BASE + """, c as (select encounter_id as row_id, y_30d,
  case when coalesce(age in ('[0-10)', '[10-20)', '[20-30)', '[30-40)', '[40-50)'), false) then 'young' else 'old' end as cohort from cohort),
y as (select * from c where cohort = 'young'), """ + _strat_sql("y", "row_id", "y_30d", "shift_split", 0.2, "0.15") + """
select 'in' as split, count(*)::BIGINT as n, sum(y_30d)::BIGINT as n_pos, true as auc_valid, true as delta_valid, true as c_in_grid, true as coefs_named from s2 where split = 'test'
union all select 'out', count(*)::BIGINT, sum(y_30d)::BIGINT, true, true, true, true from c where cohort = 'old'""")
def q_shift_eval(spark, sf):
    """Fitted on those under 50 with the C that validation picks; held-out under 50 (in) and 50 up (out)."""
    slim = FE.features_slim(C.cohort_mask(cohort_df(spark, sf)), keep=["cohort"])
    table, choice, coefs = SE.shift_eval(slim, _NUM, _CAT)
    named = coefs.count() == len({r["feature"] for r in coefs.collect()}) > len(_NUM)
    return table.select("split", "n", "n_pos", F.col("auc").between(0.0, 1.0).alias("auc_valid"), F.col("delta_auc").between(-1.0, 1.0).alias("delta_valid"),
                        F.lit(choice.params in SE.SHIFT_GRID).alias("c_in_grid"), F.lit(named).alias("coefs_named"))


@query("fit_gbt", _TEST_SQL + "select 'gbt' as model, n, n_pos, true as scores_valid, true as auc_valid, 100 as n_trees from t")
def q_fit_gbt(spark, sf):
    """100 weighted trees of depth 4 on slim features; a round of boosting is five jobs, so the library's default of 300 takes three minutes here."""
    with SE.vectors(*_slim(spark, sf)) as v:
        m = MD.gbt(max_depth=4, n_iter=100, weight_col="boosted", bins=v.bins).fit(v.part("train"))
        return _facts(SE.predicted(m, v.part("test"), "gbt"), n_trees=m.getNumTrees)


@query("fit_mlp", _TEST_SQL + "select 'mlp_64_32' as model, n, n_pos, true as scores_valid, true as auc_valid, 4 as n_layers from t")
def q_fit_mlp(spark, sf):
    with SE.vectors(*_slim(spark, sf)) as v:
        m = MD.mlp(v.width, (64, 32)).fit(v.part("train"))
        return _facts(SE.predicted(m, v.part("test"), "mlp_64_32"), n_layers=len(m.getLayers()))


_GRIDS = {"logreg": (SE.LOGREG_GRID, SE.logreg_fits), "gbt": (SE.GBT_GRID, SE.gbt_fits), "mlp": (SE.MLP_GRID, SE.mlp_fits)}


@query("grid_select", _SPLIT_SQL + """, g as (select * from (values ('logreg', 6), ('gbt', 8), ('mlp', 2)) v(family, n_tried)),
t as (select count(*) filter (split = 'train')::BIGINT as n_train, count(*) filter (split = 'val')::BIGINT as n_val, count(*) filter (split = 'test')::BIGINT as n_test,
  sum(y_30d) filter (split = 'test')::BIGINT as n_pos from s2)
select family, n_tried, n_train, n_val, n_test, n_pos, true as scores_valid, true as in_grid, true as first_best from g cross join t""")
def q_grid_select(spark, sf):
    """The study's three grids over one split: the first configuration of the highest validation AUC, scored on the test rows."""
    out = []
    with SE.vectors(*_slim(spark, sf)) as v:
        counts = {r["split"]: r["count"] for r in v.rows.groupBy("split").count().collect()}  # three rows
        for family, (grid, fits) in _GRIDS.items():
            best = SE.grid_select(v, grid, fits())
            known = [(p, a) for p, a in best.tried if a is not None]
            first = next(p for p, a in known if a == max(a for _, a in known))
            fact = _facts(SE.predicted(best.model, v.part("test"), family)).select(
                F.col("model").alias("family"), F.lit(len(best.tried)).alias("n_tried"),
                *[F.lit(counts.get(s, 0)).cast("long").alias(f"n_{s}") for s in ("train", "val")], F.col("n").alias("n_test"), "n_pos", "scores_valid",
                F.lit(best.params in grid).alias("in_grid"), F.lit(best.params == first and 0 <= best.auc <= 1).alias("first_best"))
            out.append(fact)
    return reduce(DataFrame.unionByName, out)


@query("early_stop_val", _TEST_SQL + "select 'gbt' as model, n, n_pos, true as scores_valid, true as auc_valid, true as below_limit from t")
def q_early_stop_val(spark, sf):
    """Boosting of at most 2000 trees that the validation rows end."""
    with SE.vectors(*_slim(spark, sf)) as v:
        m = SE.early_stop_val(v)
        return _facts(SE.predicted(m, v.part("test"), "gbt"), below_limit=m.getNumTrees < 2000)


_GK = sql_keyed_hash(["patient_nbr"], 42, "group_kfold")


@query("cv_auc", cte("encounters") + f""", e as (select encounter_id as row_id, patient_nbr, coalesce(cast(readmitted = '<30' as int), 0) as y from encounters
  where coalesce(discharge_disposition_id not in (11, 13, 14, 19, 20, 21), true)),
g as (select patient_nbr, sum(y) as pos, count(*) as n from e group by patient_nbr),
r as (select patient_nbr, row_number() over (order by pos desc, n desc, {_GK}, patient_nbr) - 1 as place from g),
f as (select patient_nbr, case when (place // 5) % 2 = 0 then place % 5 else 4 - place % 5 end as fold from r)
select cast(f.fold as int) as fold, count(*)::BIGINT as n, sum(e.y)::BIGINT as n_pos, 'delong' as method, true as auc_valid from e join f on e.patient_nbr = f.patient_nbr group by f.fold""")
def q_cv_auc(spark, sf):
    """Five folds that keep a patient's encounters together: each scored by a logistic model of the other four."""
    enc = C.clean_cohort(view(spark, sf, "encounters"), dedupe=False)
    slim = FE.features_slim(enc, keep=["patient_nbr"])
    out = SE.cv_auc(slim, _NUM, _CAT, SE.fit_logreg, group="patient_nbr")
    return out.select("fold", "n", "n_pos", "method", (F.col("auc").between(0.0, 1.0) & (F.col("ci_lo") <= F.col("auc")) & (F.col("auc") <= F.col("ci_hi"))).alias("auc_valid"))


_NATIVE_LEVELS = " union all ".join(f"select '{c}' as var, count(distinct coalesce(cast({c} as varchar), '?')) as n from tr" for c in FE.NATIVE_CATEGORICAL)


@query("fit_native_cat", _TEST_SQL.rstrip() + f""", tr as (select co.* from cohort co join s2 on co.encounter_id = s2.row_id where s2.split = 'train'),
lv as (select max(n) as most from ({_NATIVE_LEVELS}) x)
select 'gbt_raw_codes' as model, n, n_pos, true as scores_valid, true as auc_valid, most::BIGINT as most_levels, true as bins_hold_levels, true as depth_held, {len(FE.NATIVE_CATEGORICAL)} as n_nominal from t cross join lv""")
def q_fit_native_cat(spark, sf):
    """Boosted trees on raw codes as nominal attributes, stopped on the validation rows; unseen codes are scored too."""
    df, numeric, categorical, _ = SE.feature_frame("native", split_cohort(spark, sf))
    with SE.vectors(df, numeric, categorical, native=True) as v:
        m = SE.early_stop_val(v, max_depth=6, lr=0.05)
        levels = [len(x) for s in v.feats.stages if hasattr(s, "labelsArray") for x in s.labelsArray]
        attrs = v.rows.schema["features"].metadata["ml_attr"]["attrs"]
        return _facts(SE.predicted(m, v.part("test"), "gbt_raw_codes"), most_levels=max(levels), bins_hold_levels=m.getMaxBins() > max(levels),
                      depth_held=max(t.depth for t in m.trees) <= 6, n_nominal=len(attrs["nominal"])).withColumn("most_levels", F.col("most_levels").cast("long"))
