"""Catalogued queries: exact AUC, DeLong intervals, ROC, operating points."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions.stats import r6 as sr6
from riskloom.operators import cohort as C
from riskloom.operators import metrics as M
from riskloom.plans import sqlgen
from riskloom.plans.cohort_catalog import _COHORT, cohort_df, labelled_docs
from riskloom.plans.registry import query, r6
from riskloom.sources.fixtures import cte
from riskloom.sources.tables import read_table

_DOCS = "select d.lang as lang, d.n_chars as score, l.{y} as y from labels l join documents d on l.doc_id = d.doc_id"
_EVENTS = "select event_type, value as score, case when event_type = 'purchase' then 1 else 0 end as y from events"


def events_scored(spark, sf):
    ev = read_table(spark, sf, "events").select("event_type", "value")
    return ev.withColumn("y", (F.col("event_type") == "purchase").cast("int"))


@query("auc_exact", "select n, n_pos, auc from (" + sqlgen.delong(_DOCS.format(y="quality")) + ") x")
def q_auc_exact(spark, sf):
    return M.auc_exact(labelled_docs(spark, sf), [], "n_chars", "quality")


@query("auc_delong_ci", sqlgen.delong(_EVENTS))
def q_auc_delong_ci(spark, sf):
    return M.auc_delong(events_scored(spark, sf), [], "value", "y")


@query("auc_by_group", sqlgen.delong(_DOCS.format(y="toxic"), ["lang"]))
def q_auc_by_group(spark, sf):
    return M.auc_delong(labelled_docs(spark, sf), ["lang"], "n_chars", "toxic")


@query("roc_curve", sqlgen.roc(_EVENTS))
def q_roc_curve(spark, sf):
    return M.roc_curve(events_scored(spark, sf), [], "value", "y")


@query("cumulative_counts", sqlgen.roc(_DOCS.format(y="quality"), ["lang"]))
def q_cumulative_counts(spark, sf):
    return M.roc_curve(labelled_docs(spark, sf), ["lang"], "n_chars", "quality")


_OP_POINT = f"""threshold, {r6('tp * 1.0e0 / pos_total')} as sens, {r6('(neg_total - fp) * 1.0e0 / neg_total')} as spec,
  {r6('case when tp + fp > 0 then tp * 1.0e0 / (tp + fp) end')} as ppv,
  {r6('case when (neg_total - fp) + (pos_total - tp) > 0 then (neg_total - fp) * 1.0e0 / ((neg_total - fp) + (pos_total - tp)) end')} as npv"""

_OPS_SQL = sqlgen.roc(_DOCS.format(y="quality"), ["lang"]).replace(
    "\nselect lang, score as threshold", ",\nr as (select lang, score as threshold", 1) + f"""),
rr as (select *, tp * 1.0e0 / pos_total as sens_, (neg_total - fp) * 1.0e0 / neg_total as spec_ from r)
select lang, 'youden' as rule, {_OP_POINT} from (
  select *, row_number() over (partition by lang order by sens_ - (fp * 1.0e0 / neg_total) desc, threshold desc) as rn from rr) x where rn = 1
union all
select lang, 'sens95', {_OP_POINT} from (
  select *, row_number() over (partition by lang order by spec_ desc, threshold desc) as rn from rr where sens_ >= 0.95) x where rn = 1
union all
select lang, 'spec95', {_OP_POINT} from (
  select *, row_number() over (partition by lang order by sens_ desc, threshold desc) as rn from rr where spec_ >= 0.95) x where rn = 1"""


@query("operating_points", _OPS_SQL)
def q_operating_points(spark, sf):
    roc = M.roc_curve(labelled_docs(spark, sf), ["lang"], "n_chars", "quality")
    return M.operating_points(roc, ["lang"]).where(F.col("threshold").isNotNull())


_COHORT_SCORED = ("select case when coalesce(age in ('[0-10)', '[10-20)', '[20-30)', '[30-40)', '[40-50)'), false) "
                  "then 'young' else 'old' end as cohort, number_inpatient as score, y_30d as y from cohort")


def _delta_sql():
    inner = sqlgen.delong(_COHORT_SCORED, ["cohort"], prefix=",")
    return (cte("encounters") + "," + _COHORT + inner.replace("\nselect cohort, n::BIGINT", ",\nres as (select cohort, n::BIGINT", 1)
            + f""")
select {r6("max(case when cohort = 'young' then auc end)")} as auc_young,
       {r6("max(case when cohort = 'old' then auc end)")} as auc_old,
       {r6("max(case when cohort = 'young' then auc end) - max(case when cohort = 'old' then auc end)")} as delta_auc
from res""")


@query("delta_auc", _delta_sql())
def q_delta_auc(spark, sf):
    c = C.cohort_mask(cohort_df(spark, sf, ["age", "number_inpatient"]))
    a = M.auc_delong(c, ["cohort"], "number_inpatient", "y_30d")
    p = a.groupBy().pivot("cohort", ["young", "old"]).agg(F.first("auc"))
    return p.select(sr6("young").alias("auc_young"), sr6("old").alias("auc_old"),
                    sr6(F.col("young") - F.col("old")).alias("delta_auc"))
