"""Catalogued queries: keyed-hash splits, folds, samples, chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions.hashing import sql_keyed_hash
from riskloom.operators import cohort as C
from riskloom.operators import split as S
from riskloom.plans.cohort_catalog import _COHORT, cohort_df
from riskloom.plans.registry import query
from riskloom.sources.fixtures import cte
from riskloom.sources.tables import read_table

_VR = repr(0.15 / 0.85)
_BASE = cte("encounters") + "," + _COHORT


def _strat_sql(src: str, key: str, label: str, purpose: str, test: float, vr: str) -> str:
    h = sql_keyed_hash([key], 42, purpose)
    return f"""r as (select *, row_number() over (partition by {label} order by _h, {key}) as rk,
  count(*) over (partition by {label}) as nn from (select *, {h} as _h from {src}) h0),
s as (select *, floor(nn * {test!r} + 0.5) as nt from r),
s2 as (select *, case when rk <= nt then 'test' when rk <= nt + floor((nn - nt) * {vr} + 0.5) then 'val' else 'train' end as split from s)"""


@query("split_stratified", _BASE + ", c as (select encounter_id as row_id, y_30d from cohort), "
       + _strat_sql("c", "row_id", "y_30d", "split", 0.15, _VR) + "\nselect row_id, y_30d, split from s2")
def q_split_stratified(spark, sf):
    c = cohort_df(spark, sf, []).select("row_id", "y_30d")
    return S.split_stratified(c, "row_id", "y_30d").select("row_id", "y_30d", "split")


@query("complement_ids", _BASE + ", c as (select encounter_id as row_id, y_30d from cohort), "
       + _strat_sql("c", "row_id", "y_30d", "split", 0.15, _VR)
       + "\nselect row_id from c where row_id not in (select row_id from s2 where split in ('test', 'val'))")
def q_complement_ids(spark, sf):
    c = cohort_df(spark, sf, []).select("row_id", "y_30d")
    s = S.split_stratified(c, "row_id", "y_30d")
    return S.complement_ids(c.select("row_id"), s.where("split = 'test'"), s.where("split = 'val'"),
                            key="row_id")


@query("split_cohort_holdout", _BASE + """, c as (select encounter_id as row_id, y_30d,
  case when coalesce(age in ('[0-10)', '[10-20)', '[20-30)', '[30-40)', '[40-50)'), false) then 'young' else 'old' end as cohort
  from cohort), y as (select * from c where cohort = 'young'), """
       + _strat_sql("y", "row_id", "y_30d", "shift_split", 0.2, "0.15")
       + "\nselect row_id, cohort, split from s2 union all select row_id, cohort, 'holdout' from c where cohort = 'old'")
def q_split_cohort_holdout(spark, sf):
    c = C.cohort_mask(cohort_df(spark, sf, ["age"])).select("row_id", "y_30d", "cohort")
    young = S.split_stratified(c.where("cohort = 'young'"), "row_id", "y_30d", test=0.2,
                               val_of_rest=0.15, purpose="shift_split")
    old = c.where("cohort = 'old'").withColumn("split", F.lit("holdout"))
    return young.unionByName(old).select("row_id", "cohort", "split")


_GH = sql_keyed_hash(["user_id"], 42, "group_split")


@query("split_group", f"""with g as (select user_id, {_GH} as _h from (select distinct user_id from events where user_id is not null) d),
r as (select *, row_number() over (order by _h, user_id) as rk, count(*) over () as nn from g),
gs as (select user_id, case when rk <= floor(nn * 0.15) then 'test' when rk <= floor(nn * 0.15) + floor(nn * 0.15) then 'val' else 'train' end as split from r)
select e.event_id, e.user_id, coalesce(gs.split, 'train') as split from events e left join gs on e.user_id = gs.user_id""")
def q_split_group(spark, sf):
    ev = read_table(spark, sf, "events").select("event_id", "user_id")
    return S.split_group(ev, "user_id").select("event_id", "user_id", "split")


@query("kfold_stratified", _BASE + f""", c as (select encounter_id as row_id, y_30d, {sql_keyed_hash(['encounter_id'], 42, 'kfold')} as _h from cohort)
select row_id, y_30d, cast(((row_number() over (partition by y_30d order by _h, row_id)) - 1) % 5 as int) as fold from c""")
def q_kfold_stratified(spark, sf):
    c = cohort_df(spark, sf, []).select("row_id", "y_30d")
    return S.kfold_stratified(c, "row_id", "y_30d", 5).select("row_id", "y_30d", "fold")


_GK = _GH.replace("group_split", "group_kfold")


@query("kfold_stratified_group", f"""with e as (select event_id, user_id, case when event_type = 'purchase' then 1 else 0 end as y from events),
g as (select user_id, sum(y) as pos, count(*) as n from e where user_id is not null group by user_id),
r as (select user_id, row_number() over (order by pos desc, n desc, {_GK}, user_id) - 1 as place from g),
gf as (select user_id, case when (place // 5) % 2 = 0 then place % 5 else 4 - place % 5 end as fold from r),
alone as (select event_id, user_id, (row_number() over (partition by y order by {_GK.replace("user_id", "event_id")}, event_id) - 1) % 5 as fold from e where user_id is null)
select e.event_id, e.user_id, cast(gf.fold as int) as fold from e join gf on e.user_id = gf.user_id union all select event_id, user_id, cast(fold as int) from alone""")
def q_kfold_stratified_group(spark, sf):
    ev = read_table(spark, sf, "events").select("event_id", "user_id", (F.col("event_type") == "purchase").cast("int").alias("y"))
    return S.kfold_stratified_group(ev, "user_id", "y", 5, key="event_id").select("event_id", "user_id", "fold")


def _sample_sql(src_cte: str, key: str, label: str, n_rows: int, keep_all: bool) -> str:
    h = sql_keyed_hash([key], 42, "sample")
    keep = f" or {n_rows} >= nn_all" if keep_all else ""
    return src_cte + f""", r as (select *, row_number() over (partition by {label} order by {h}, {key}) as rk from src),
tots as (select count(*) as nn_all, sum({label}) as pp from src),
k as (select r.*, tots.*, least(cast(floor(({n_rows} * pp) * 1.0e0 / nn_all) as bigint) + 1, pp) as kpos from r cross join tots)
select {key}, {label} from k where rk <= case when {label} = 1 then kpos else {n_rows} - kpos end{keep}"""


@query("sample_stratified_n", _sample_sql(_BASE + ", src as (select encounter_id as row_id, y_30d from cohort)",
                                         "row_id", "y_30d", 300, False))
def q_sample_stratified_n(spark, sf):
    c = cohort_df(spark, sf, []).select("row_id", "y_30d")
    return S.sample_stratified_n(c, "row_id", "y_30d", 300).select("row_id", "y_30d")


@query("sample_train_stratified", _sample_sql(
    "with src as (select event_id, case when event_type = 'purchase' then 1 else 0 end as y from events)",
    "event_id", "y", 2000, True))
def q_sample_train_stratified(spark, sf):
    ev = read_table(spark, sf, "events").select("event_id", (F.col("event_type") == "purchase").cast("int").alias("y"))
    return S.sample_stratified_n(ev, "event_id", "y", 2000, keep_all_if_larger=True)


@query("chunk_assign", """select o_orderkey as row_id,
  cast(floor((row_number() over (order by o_orderkey) * 7 + count(*) over () - 1) * 1.0e0 / count(*) over ()) - 1 as int) as chunk_id
from orders""")
def q_chunk_assign(spark, sf):
    o = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id"))
    return S.chunk_assign(o, "row_id", 7)
