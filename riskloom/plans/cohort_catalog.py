"""Catalogued queries: rates, cohort construction, cohort strata."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions.stats import sql_wilson
from riskloom.operators import cohort as C
from riskloom.operators import rates as R
from riskloom.plans.registry import query, r6
from riskloom.sources.fixtures import cte, view
from riskloom.sources.tables import read_table

_LO, _HI = sql_wilson("k", "n")


def _wilson_tail(k="k", n="n"):
    lo, hi = sql_wilson(k, n)
    return f"{r6(f'{k} * 1.0e0 / {n}')} as rate, {r6(lo)} as ci_lo, {r6(hi)} as ci_hi"


def labelled_docs(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    lab = read_table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    return lab.join(docs, "doc_id")


@query("rate_wilson", f"""
select lang, n, k, {_wilson_tail()} from (
  select d.lang as lang, count(*)::BIGINT as n, sum(l.toxic)::BIGINT as k
  from labels l join documents d on l.doc_id = d.doc_id
  where d.lang is not null group by d.lang) t""")
def q_rate_wilson(spark, sf):
    return R.rate_wilson(labelled_docs(spark, sf), "lang", "toxic", category_name="lang")


@query("sort_rate_desc", f"""
select lang, n, k, {_wilson_tail()} from (
  select d.lang as lang, count(*)::BIGINT as n, sum(l.quality)::BIGINT as k
  from labels l join documents d on l.doc_id = d.doc_id
  where d.lang is not null group by d.lang) t order by rate desc, lang""")
def q_sort_rate_desc(spark, sf):
    r = R.rate_wilson(labelled_docs(spark, sf), "lang", "quality", category_name="lang")
    return R.sort_rate_desc(r, key="lang")


@query("having_min_n", f"""
select hour, n, k, {_wilson_tail()} from (
  select cast(extract(hour from ts) as int) as hour, count(*)::BIGINT as n,
         sum(case when event_type = 'purchase' then 1 else 0 end)::BIGINT as k
  from events where ts is not null group by 1) t where n >= 30""")
def q_having_min_n(spark, sf):
    ev = read_table(spark, sf, "events").select(F.hour("ts").alias("hour"), "event_type")
    r = R.rate_wilson(ev, "hour", F.col("event_type") == "purchase", category_name="hour")
    return R.having_min_n(r, 30)


_COHORT = """cohort as (
  select * from (
    select *, row_number() over (partition by patient_nbr order by encounter_id) as _rn
    from (select *, coalesce(cast(readmitted = '<30' as int), 0) as y_30d from encounters) e
    where coalesce(discharge_disposition_id not in (11, 13, 14, 19, 20, 21), true)) x
  where _rn = 1)
"""


def cohort_df(spark, sf, columns=None):
    return C.clean_cohort(view(spark, sf, "encounters"), columns=columns)


@query("rate_wilson_sets", cte("encounters") + "," + _COHORT + f"""
select variable, category, n, k, {_wilson_tail()} from (
  select variable, category, count(*)::BIGINT as n, sum(y_30d)::BIGINT as k from (
    select 'age' as variable, age as category, y_30d from cohort
    union all select 'gender', gender, y_30d from cohort
    union all select 'race', race, y_30d from cohort) u
  where category is not null group by variable, category) t""")
def q_rate_wilson_sets(spark, sf):
    return R.rate_wilson_sets(cohort_df(spark, sf, ["age", "gender", "race"]), ["age", "gender", "race"], "y_30d")


@query("reindex_ordered", cte("encounters") + "," + _COHORT + """,
bins as (select * from (values (0, '[0-10)'), (1, '[10-20)'), (2, '[20-30)'), (3, '[30-40)'),
  (4, '[40-50)'), (5, '[50-60)'), (6, '[60-70)'), (7, '[70-80)'), (8, '[80-90)'), (9, '[90-100)'),
  (10, '[100-110)')) v(pos, category)),
r as (select age as category, count(*)::BIGINT as n, sum(y_30d)::BIGINT as k from cohort
      where age is not null group by age)
select b.category, r.n, r.k, """ + _wilson_tail("r.k", "r.n") + """
from bins b left join r on b.category = r.category order by b.pos""")
def q_reindex_ordered(spark, sf):
    from riskloom.functions.vocab import AGE_MIDPOINTS
    r = R.rate_wilson(cohort_df(spark, sf, ["age"]), "age", "y_30d")
    # an extra bin beyond the data shows the absent-bin -> null-row behaviour
    return R.reindex_ordered(r, list(AGE_MIDPOINTS) + ["[100-110)"])


@query("label_binary", cte("encounters") + """
select encounter_id, readmitted, coalesce(cast(readmitted = '<30' as int), 0) as y_30d from encounters""")
def q_label_binary(spark, sf):
    return C.label_binary(view(spark, sf, "encounters")).select("encounter_id", "readmitted", "y_30d")


@query("filter_exclusion_set", cte("encounters") + """
select encounter_id, discharge_disposition_id from encounters
where coalesce(discharge_disposition_id not in (11, 13, 14, 19, 20, 21), true)""")
def q_filter_exclusion_set(spark, sf):
    return C.filter_exclusion_set(view(spark, sf, "encounters")).select(
        "encounter_id", "discharge_disposition_id")


@query("first_per_entity", """
select o_custkey, o_orderkey, o_orderstatus, o_totalprice from (
  select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as rn
  from orders) t where rn = 1""")
def q_first_per_entity(spark, sf):
    o = read_table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey",
                                                 "o_orderstatus", "o_totalprice")
    return C.first_per_entity(o, "o_custkey", ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("clean_cohort", cte("encounters") + "," + _COHORT + """
select encounter_id as row_id, patient_nbr, race, gender, age, discharge_disposition_id,
       diag_1, a1cresult, insulin, y_30d from cohort""")
def q_clean_cohort(spark, sf):
    return cohort_df(spark, sf).select("row_id", "patient_nbr", "race", "gender", "age",
                                        "discharge_disposition_id", "diag_1", "a1cresult",
                                        "insulin", "y_30d")


@query("drop_if_present", cte("encounters") + """
select * exclude (encounter_id) from encounters""")
def q_drop_if_present(spark, sf):
    return C.drop_if_present(view(spark, sf, "encounters"))


@query("cohort_mask", cte("encounters") + "," + _COHORT + """
select row_id, age, cohort from (select encounter_id as row_id, age,
  case when coalesce(age in ('[0-10)', '[10-20)', '[20-30)', '[30-40)', '[40-50)'), false)
       then 'young' else 'old' end as cohort from cohort) t""")
def q_cohort_mask(spark, sf):
    return C.cohort_mask(cohort_df(spark, sf, ["age"])).select("row_id", "age", "cohort")


@query("prevalence_by_cohort", cte("encounters") + "," + _COHORT + """
select cohort, count(*)::BIGINT as n, """ + r6("avg(y_30d)") + """ as rate from (
  select y_30d, case when coalesce(age in ('[0-10)', '[10-20)', '[20-30)', '[30-40)', '[40-50)'), false)
       then 'young' else 'old' end as cohort from cohort) t group by cohort""")
def q_prevalence_by_cohort(spark, sf):
    from riskloom.functions.stats import r6 as sr6
    c = C.cohort_mask(cohort_df(spark, sf, ["age"]))
    return c.groupBy("cohort").agg(F.count(F.lit(1)).alias("n"), sr6(F.avg("y_30d")).alias("rate"))


@query("cast_categorical", cte("encounters") + """
select encounter_id, coalesce(cast(admission_type_id as varchar), '?') as admission_type_id,
       coalesce(a1cresult, '?') as a1cresult, coalesce(max_glu_serum, '?') as max_glu_serum
from encounters""")
def q_cast_categorical(spark, sf):
    e = view(spark, sf, "encounters").select("encounter_id", "admission_type_id", "a1cresult",
                                             "max_glu_serum")
    return C.cast_categorical(e, ["admission_type_id", "a1cresult", "max_glu_serum"])


@query("select_by_prefix", cte("encounters") + """
select encounter_id, number_outpatient, number_emergency, number_inpatient, number_diagnoses
from encounters""")
def q_select_by_prefix(spark, sf):
    return C.select_by_prefix(view(spark, sf, "encounters"), "number_", keep=["encounter_id"])


@query("normalize_names", cte("encounters") + """
select distinct 'medical_specialty_' || replace(replace(replace(replace(medical_specialty, '[', ''), ')', ''), ' ', '_'), '/', '_') as feature
from encounters union
select distinct 'age_' || replace(replace(replace(replace(age, '[', ''), ')', ''), ' ', '_'), '/', '_') from encounters""")
def q_normalize_names(spark, sf):
    e = view(spark, sf, "encounters")
    a = e.select(F.concat(F.lit("medical_specialty_"), C.normalize_col("medical_specialty")).alias("feature"))
    b = e.select(F.concat(F.lit("age_"), C.normalize_col("age")).alias("feature"))
    return a.union(b).distinct()
