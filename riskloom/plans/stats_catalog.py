"""Catalogued queries: target encodings, class weights, SMD, quantiles, top-k, formatting."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions import text as T
from riskloom.functions.hashing import sql_keyed_hash
from riskloom.functions.stats import r6 as sr6
from riskloom.functions.vocab import ACTIVE_DRUGS
from riskloom.operators import cohort as C
from riskloom.operators import encode as EN
from riskloom.operators import features as FE
from riskloom.operators import metrics as M
from riskloom.operators import shift as SH
from riskloom.operators import split as S
from riskloom.plans import sqlgen
from riskloom.plans.cohort_catalog import _COHORT, cohort_df, labelled_docs
from riskloom.plans.feature_catalog import _features_sql, _norm_sql
from riskloom.plans.registry import query, r6
from riskloom.plans.split_catalog import _VR, _strat_sql
from riskloom.sources.fixtures import cte
from riskloom.sources.tables import read_table

_BASE = cte("encounters") + "," + _COHORT


@query("target_mean_smoothed", f"""with g as (select avg(case when l_returnflag = 'R' then 1.0e0 else 0.0e0 end) as g from lineitem)
select l_suppkey, count(*)::BIGINT as n, {r6('(sum(case when l_returnflag = ' + "'R'" + ' then 1.0e0 else 0.0e0 end) + max(g.g) * 20.0e0) / (count(*) + 20.0e0)')} as enc
from lineitem cross join g where l_suppkey is not null group by l_suppkey""")
def q_target_mean_smoothed(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_suppkey", (F.col("l_returnflag") == "R").cast("int").alias("y"))
    t = EN.target_mean_table(li, "l_suppkey", "y")
    return t.select("l_suppkey", "n", sr6("enc").alias("enc"))


_EV_FOLD = f"""ev as (select event_id, user_id, case when event_type = 'purchase' then 1 else 0 end as y,
  {sql_keyed_hash(['event_id'], 42, 'kfold')} as _h from events),
f as (select *, cast((row_number() over (partition by y order by _h, event_id) - 1) % 5 as int) as fold from ev)"""


@query("target_oof", "with " + _EV_FOLD + f""",
g as (select avg(y * 1.0e0) as g from f),
per as (select user_id, fold, count(*) as cf, sum(y * 1.0e0) as sf from f where user_id is not null group by user_id, fold),
tot as (select user_id, fold, sum(cf) over (partition by user_id) - cf as co, sum(sf) over (partition by user_id) - sf as so from per)
select f.event_id, f.fold, {r6('(coalesce(tot.so, 0) + g.g * 20.0e0) / (coalesce(tot.co, 0) + 20.0e0)')} as user_id_te
from f left join tot on f.user_id = tot.user_id and f.fold = tot.fold cross join g""")
def q_target_oof(spark, sf):
    ev = read_table(spark, sf, "events").select("event_id", "user_id", (F.col("event_type") == "purchase").cast("int").alias("y"))
    f = S.kfold_stratified(ev, "event_id", "y", 5)
    return EN.target_oof(f, "user_id", "y", "fold").select("event_id", "fold", sr6("user_id_te").alias("user_id_te"))


_SPLIT = ", c as (select encounter_id as row_id, y_30d from cohort), " + _strat_sql("c", "row_id", "y_30d", "split", 0.15, _VR)


def _split_cohort(spark, sf):
    c = cohort_df(spark, sf, []).select("row_id", "y_30d")
    return S.split_stratified(c, "row_id", "y_30d")


@query("class_weight_ratio", _BASE + _SPLIT + f"""
select sum(y_30d)::BIGINT as n_pos, (count(*) - sum(y_30d))::BIGINT as n_neg,
  {r6('(count(*) - sum(y_30d)) * 1.0e0 / greatest(sum(y_30d), 1)')} as ratio from s2 where split = 'train'""")
def q_class_weight_ratio(spark, sf):
    r = EN.class_weight_ratio(_split_cohort(spark, sf).where("split = 'train'"), "y_30d")
    return r.select("n_pos", "n_neg", sr6("ratio").alias("ratio"))


@query("class_weight_balanced", _BASE + _SPLIT + f"""
, t as (select * from s2 where split = 'train')
select row_id, y_30d, {r6('(select count(*) from t) * 1.0e0 / (2.0e0 * count(*) over (partition by y_30d))')} as weight from t""")
def q_class_weight_balanced(spark, sf):
    w = EN.class_weight_balanced(_split_cohort(spark, sf).where("split = 'train'"), "y_30d")
    return w.select("row_id", "y_30d", sr6("weight").alias("weight"))


@query("cohort_summary", _BASE + _SPLIT + f"""
select count(*)::BIGINT as n, sum(y_30d)::BIGINT as n_pos, {r6('avg(y_30d * 1.0e0)')} as rate,
  count(*) filter (where split = 'train')::BIGINT as n_train, count(*) filter (where split = 'val')::BIGINT as n_val,
  count(*) filter (where split = 'test')::BIGINT as n_test from s2""")
def q_cohort_summary(spark, sf):
    s = _split_cohort(spark, sf)
    return s.agg(F.count(F.lit(1)).alias("n"), F.sum("y_30d").cast("long").alias("n_pos"),
                 sr6(F.avg(F.col("y_30d").cast("double"))).alias("rate"),
                 *[F.sum((F.col("split") == k).cast("long")).alias(f"n_{k}") for k in ("train", "val", "test")])


_LI_NUM = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _smd_dense_sql(src: str, cols, grp: str, a: str, b: str) -> str:
    un = " union all ".join(f"select {grp} as g, '{c}' as feature, cast({c} as double) as value from {src}" for c in cols)
    return f"""with l as (select * from ({un}) u where value is not null and g in ('{a}', '{b}')),
agg as (select feature, avg(case when g = '{a}' then value end) as ma, avg(case when g = '{b}' then value end) as mb,
  stddev_samp(value) as sd from l group by feature)
select feature, {r6('ma')} as mean_a, {r6('mb')} as mean_b, {r6('sd')} as std_all,
  {r6('case when sd > 1e-12 then (mb - ma) / sd end')} as smd, {r6('abs(mb - ma)')} as abs_diff from agg"""


@query("smd_features", _smd_dense_sql("(select *, case when l_returnflag = 'R' then 'R' else 'rest' end as grp from lineitem) li",
                                      _LI_NUM, "grp", "rest", "R"))
def q_smd_features(spark, sf):
    li = read_table(spark, sf, "lineitem").select(*_LI_NUM, F.when(F.col("l_returnflag") == "R", "R").otherwise("rest").alias("grp"))
    return SH.smd_dense(li, _LI_NUM, "grp", "rest", "R")


@query("abs_mean_diff", "select feature, abs_diff from (" + _smd_dense_sql(
    "(select case when event_type = 'purchase' then 'purchase' else 'rest' end as grp, value, cast(json_extract_string(props, '$.k') as double) as k from events) e",
    ("value", "k"), "grp", "rest", "purchase") + ") x")
def q_abs_mean_diff(spark, sf):
    """Purchases against all other events."""
    kind = F.when(F.col("event_type") == "purchase", "purchase").otherwise("rest")
    ev = read_table(spark, sf, "events").select(kind.alias("grp"), "value", F.get_json_object("props", "$.k").try_cast("double").alias("k"))
    return SH.smd_dense(ev, ("value", "k"), "grp", "rest", "purchase").select("feature", "abs_diff")


_SLIM_CATS = list(FE.SLIM_CATEGORICAL) + list(ACTIVE_DRUGS)


def _topk_smd_sql() -> str:
    fs = _features_sql(True)
    body = fs[fs.index("select encounter_id as row_id, y_30d,"):]
    pre = fs[:fs.index("select encounter_id as row_id, y_30d,")]
    num_long = " union all ".join(f"select row_id, '{c}' as feature, {c} as value from slim" for c in FE.SLIM_NUMERIC)
    cat_long = " union all ".join(f"select row_id, '{c}' as var, {c} as lvl from slim" for c in _SLIM_CATS)
    return (pre.rstrip() + f""", slim0 as ({body}),
slim as (select s.*, case when coalesce(c.age in ('[0-10)', '[10-20)', '[20-30)', '[30-40)', '[40-50)'), false) then 'young' else 'old' end as grp
  from slim0 s join cohort c on s.row_id = c.encounter_id),
cl as ({cat_long}), firsts as (select var, min(lvl) as fl from cl group by var),
long as ({num_long} union all select row_id, var || '_' || {_norm_sql('lvl')}, 1.0e0 from cl join firsts using (var) where lvl <> fl),
sizes as (select sum(case when grp = 'young' then 1 else 0 end) as na, sum(case when grp = 'old' then 1 else 0 end) as nb from slim),
agg as (select feature, sum(case when grp = 'young' then value else 0 end) as sa, sum(case when grp = 'old' then value else 0 end) as sb,
  sum(value * value) as ss, feature in ({", ".join(f"'{c}'" for c in FE.SLIM_NUMERIC)}) as num, stddev_samp(value) as sd_num,
  count(case when grp = 'young' then value end) as ca, count(case when grp = 'old' then value end) as cb
  from long join slim using (row_id) group by feature),
m as (select feature, sa / (case when num then ca else na end) as ma, sb / (case when num then cb else nb end) as mb,
  case when num then sd_num else sqrt(greatest((ss - (sa + sb) * (sa + sb) / (na + nb)) / (na + nb - 1), 0)) end as sd from agg cross join sizes),
s as (select feature, {r6('case when sd > 1e-12 then (mb - ma) / sd end')} as smd from m)
select * from (select feature, smd, 'lowest' as "end" from s where smd is not null order by smd asc, feature limit 8)
union all select * from (select feature, smd, 'highest' from s where smd is not null order by smd desc, feature limit 8)""")


@query("topk_smd", _topk_smd_sql())
def q_topk_smd(spark, sf):
    from riskloom.session import cut_lineage
    coh = C.cohort_mask(cohort_df(spark, sf))
    # the slim table feeds four branches (unpivot, one-hot + its first levels,
    # stratum sizes); cut lineage once instead of re-running the dedupe per branch
    slim = cut_lineage(FE.features_slim(coh, keep=["cohort"]))
    long = SH.unpivot(slim, "row_id", FE.SLIM_NUMERIC).unionByName(FE.onehot_long(slim, "row_id", _SLIM_CATS))
    groups = slim.select("row_id", "cohort")
    smd = SH.smd_sparse(long, groups, "row_id", "cohort", "young", "old", FE.SLIM_NUMERIC)
    return SH.topk_both_ends(smd.select("feature", "smd"), "smd", 8)


@query("quantile_linear", f"""select event_type, {r6('quantile_cont(value, 0.025)')} as q025, {r6('quantile_cont(value, 0.5)')} as q50,
  {r6('quantile_cont(value, 0.975)')} as q975 from events where event_type is not null group by event_type""")
def q_quantile_linear(spark, sf):
    ev = read_table(spark, sf, "events").where(F.col("event_type").isNotNull())
    return ev.groupBy("event_type").agg(*[sr6(F.percentile("value", q)).alias(n)
                                          for q, n in ((0.025, "q025"), (0.5, "q50"), (0.975, "q975"))])


_DOCS = "select d.lang as lang, d.n_chars as score, l.toxic as y from labels l join documents d on l.doc_id = d.doc_id"


@query("format_ci", "select lang, printf('%.3f (%.3f–%.3f)', auc, ci_lo, ci_hi) as auc_ci, "
       "case when auc >= 0.65 then 'clears' else 'falls short of' end as verdict from ("
       + sqlgen.delong(_DOCS, ["lang"]) + ") x")
def q_format_ci(spark, sf):
    a = M.auc_delong(labelled_docs(spark, sf), ["lang"], "n_chars", "toxic")
    return a.select("lang", T.format_ci("auc", "ci_lo", "ci_hi").alias("auc_ci"), T.target_verdict("auc").alias("verdict"))


@query("target_verdict", "select lang, case when auc >= 0.65 then 'clears' else 'falls short of' end as verdict from ("
       + sqlgen.delong(_DOCS.replace("l.toxic", "l.quality"), ["lang"]) + ") x")
def q_target_verdict(spark, sf):
    a = M.auc_delong(labelled_docs(spark, sf), ["lang"], "n_chars", "quality")
    return a.select("lang", T.target_verdict("auc").alias("verdict"))
