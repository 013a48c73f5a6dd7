"""Catalogued queries: batch scoring, cache maintenance, retry/merge, score report."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions import text as T
from riskloom.functions.stats import r6 as sr6
from riskloom.functions.vocab import PROMPT_FORMATS
from riskloom.operators import metrics as M
from riskloom.operators import scoring as SC
from riskloom.operators import split as S
from riskloom.plans import sqlgen
from riskloom.plans.cohort_catalog import _COHORT, cohort_df
from riskloom.plans.feature_catalog import _ABBR_SQL, _NATURAL_SQL, _STRUCT_SQL, _sql_parse_prob
from riskloom.plans.registry import query, r6
from riskloom.plans.split_catalog import _VR, _strat_sql
from riskloom.sources.fixtures import cte, view
from riskloom.sources.tables import read_table

_BASE = cte("encounters", "responses") + "," + _COHORT
_STRICT = _sql_parse_prob("response", True)
_LENIENT = _sql_parse_prob("response", False)


def _requests_sql(src: str) -> str:
    return (f"select encounter_id as row_id, 'structured' as prompt_format, {_STRUCT_SQL} as prompt from {src} union all "
            f"select encounter_id, 'natural', {_NATURAL_SQL} from {src} union all "
            f"select encounter_id, 'abbreviated', {_ABBR_SQL} from {src}")


_RATES_SQL = ("c as (select encounter_id as row_id, y_30d from cohort), " + _strat_sql("c", "row_id", "y_30d", "split", 0.15, _VR) + """,
taught as (select co.number_inpatient as lv, co.y_30d as y from cohort co join s2 on co.encounter_id = s2.row_id where s2.split = 'train'),
prior as (select sum(y) * 1.0e0 / count(*) as g from taught),
rates as (select lv, (sum(y) * 1.0e0 + max(g) * 20.0e0) / (count(*) + 20.0e0) as rate from taught cross join prior group by lv)""")


def _scored_sql(req: str) -> str:
    return (f"select q.row_id, q.prompt_format, floor(coalesce(rate, g) * 1000 + 0.5) / 1000 as parsed_p from ({req}) q "
            "join encounters e on q.row_id = e.encounter_id left join rates on e.number_inpatient = rates.lv cross join prior")


def fitted_scorer(spark, sf):
    """The rate of readmission at each number of inpatient stays, learned on the training rows of the split."""
    cohort = cohort_df(spark, sf, ["number_inpatient"]).select("row_id", "y_30d", "number_inpatient")
    return SC.fit_rate_scorer(S.split_stratified(cohort, "row_id", "y_30d").where("split = 'train'"), "number_inpatient", "y_30d")


def parsed_responses(spark, sf, strict=True):
    r = view(spark, sf, "responses")
    return r.withColumn("parsed_p", T.parse_prob("response", strict=strict))


@query("build_requests", _BASE + _requests_sql("cohort"))
def q_build_requests(spark, sf):
    return SC.build_requests(cohort_df(spark, sf))


_PENDING = (f"req as ({_requests_sql('cohort')}), cache as (select row_id, prompt_format from responses where {_STRICT} is not null), "
            "pending as (select * from req r where not exists (select 1 from cache c where c.row_id = r.row_id and c.prompt_format = r.prompt_format))")


def _pending(spark, sf):
    req = SC.build_requests(cohort_df(spark, sf))
    cache = parsed_responses(spark, sf).where("parsed_p is not null")
    return SC.anti_pending(req, cache)


@query("anti_pending", _BASE + ", " + _PENDING + " select row_id, prompt_format from pending")
def q_anti_pending(spark, sf):
    return _pending(spark, sf).select("row_id", "prompt_format")


@query("score_batch", _BASE + ", " + _RATES_SQL + ", " + _PENDING + " select row_id, prompt_format, " + r6("parsed_p") + " as parsed_p from ("
       + _scored_sql("select * from pending") + ") s")
def q_score_batch(spark, sf):
    s = SC.score_batch(_pending(spark, sf), fitted_scorer(spark, sf))
    return s.select("row_id", "prompt_format", sr6("parsed_p").alias("parsed_p"))


@query("failed_calls", cte("responses") + f"select row_id, prompt_format, response from responses "
       f"where {_STRICT} is null and starts_with(response, 'Error in API')")
def q_failed_calls(spark, sf):
    return SC.failed_calls(parsed_responses(spark, sf), ("Error in API",)).select("row_id", "prompt_format", "response")


@query("sort_retry_queue", cte("responses") + f"select prompt_format, row_id from responses "
       f"where {_STRICT} is null and (starts_with(response, 'Error in API') or starts_with(response, 'Error: ')) "
       "order by prompt_format, row_id")
def q_sort_retry_queue(spark, sf):
    f = SC.failed_calls(parsed_responses(spark, sf))
    return f.select("prompt_format", "row_id").orderBy("prompt_format", "row_id")


def _retry_df(spark, sf):
    failed = SC.failed_calls(parsed_responses(spark, sf)).select("row_id", "prompt_format")
    enc = view(spark, sf, "encounters").withColumnRenamed("encounter_id", "row_id")
    req = failed.join(enc, "row_id").select("row_id", "prompt_format", SC.prompt_for().alias("prompt"))
    return SC.score_batch(req, fitted_scorer(spark, sf))


_RETRY_SQL = (_COHORT + ", " + _RATES_SQL + f", failed as (select row_id, prompt_format from responses where {_STRICT} is null and "
              "(starts_with(response, 'Error in API') or starts_with(response, 'Error: '))), "
              f"allreq as ({_requests_sql('encounters')}), "
              "req as (select a.* from allreq a join failed f on a.row_id = f.row_id and a.prompt_format = f.prompt_format), "
              f"retry as ({_scored_sql('select * from req')})")


@query("retry_pass", cte("encounters", "responses") + ", " + _RETRY_SQL + f"""
select r.row_id, r.prompt_format, {r6(f'case when t.parsed_p is not null then t.parsed_p else {_STRICT} end')} as parsed_p
from responses r left join retry t on r.row_id = t.row_id and r.prompt_format = t.prompt_format""")
def q_retry_pass(spark, sf):
    base = parsed_responses(spark, sf)
    merged = SC.merge_update_nonnull(base, _retry_df(spark, sf))
    return merged.select("row_id", "prompt_format", sr6("parsed_p").alias("parsed_p"))


@query("retry_success", cte("encounters", "responses") + ", " + _RETRY_SQL + f"""
select prompt_format, count(*)::BIGINT as n_retried, {r6('avg(case when parsed_p is not null then 1.0e0 else 0.0e0 end)')} as success_rate
from retry group by prompt_format""")
def q_retry_success(spark, sf):
    r = _retry_df(spark, sf)
    return r.groupBy("prompt_format").agg(F.count(F.lit(1)).alias("n_retried"),
                                          sr6(F.avg(F.col("parsed_p").isNotNull().cast("double"))).alias("success_rate"))


@query("merge_update_nonnull", cte("responses") + f"""
select row_id, prompt_format,
  case when lenient_p is not null then concat('retried: ', response) else response end as response,
  {r6(f'coalesce(lenient_p, strict_p)')} as parsed_p from (
  select row_id, prompt_format, response, {_STRICT} as strict_p,
    case when {_STRICT} is null then {_LENIENT} end as lenient_p from responses) x""")
def q_merge_update_nonnull(spark, sf):
    base = parsed_responses(spark, sf, strict=True)
    retry = parsed_responses(spark, sf, strict=False).join(
        base.where("parsed_p is null").select("row_id", "prompt_format"), ["row_id", "prompt_format"], "left_semi")
    retry = retry.withColumn("response", F.concat(F.lit("retried: "), "response"))  # what a merge must take over, and only where it parsed
    m = SC.merge_update_nonnull(base, retry)
    return m.select("row_id", "prompt_format", "response", sr6("parsed_p").alias("parsed_p"))


@query("dedupe_keep_last", cte("responses") + f"""
, u as (select row_id, prompt_format, 0 as file, {_STRICT} as parsed_p from responses
        union all select row_id, prompt_format, 1, {_LENIENT} from responses where starts_with(response, 'Error'))
select row_id, prompt_format, {r6('parsed_p')} as parsed_p from (
  select *, row_number() over (partition by row_id, prompt_format order by file desc) as rn from u) x where rn = 1""")
def q_dedupe_keep_last(spark, sf):
    a = parsed_responses(spark, sf).select("row_id", "prompt_format", F.lit(0).alias("file"), "parsed_p")
    b = (parsed_responses(spark, sf, strict=False).where(F.col("response").startswith("Error"))
         .select("row_id", "prompt_format", F.lit(1).alias("file"), "parsed_p"))
    d = SC.dedupe_keep_last(a.unionByName(b), ["row_id", "prompt_format"], ["file"])
    return d.select("row_id", "prompt_format", sr6("parsed_p").alias("parsed_p"))


@query("union_chunks", cte("responses") + """
select row_id, prompt_format, chunk_id, response, null::VARCHAR as note from responses where prompt_format <> 'natural'
union all select row_id, prompt_format, chunk_id, response, 'rerun' from responses where prompt_format = 'natural'""")
def q_union_chunks(spark, sf):
    r = view(spark, sf, "responses")
    a = r.where("prompt_format <> 'natural'")
    b = r.where("prompt_format = 'natural'").withColumn("note", F.lit("rerun"))
    return a.unionByName(b, allowMissingColumns=True).select("row_id", "prompt_format", "chunk_id", "response", "note")


def _labels(spark, sf):
    from riskloom.operators.cohort import label_binary
    return label_binary(view(spark, sf, "encounters")).select(F.col("encounter_id").alias("row_id"), "y_30d")


@query("join_align_labels", cte("encounters", "responses") + f"""
select r.row_id, r.prompt_format, {r6(_STRICT.replace('response', 'r.response'))} as parsed_p, coalesce(cast(e.readmitted = '<30' as int), 0) as y_30d
from responses r join encounters e on r.row_id = e.encounter_id""")
def q_join_align_labels(spark, sf):
    j = parsed_responses(spark, sf).join(_labels(spark, sf), "row_id")
    return j.select("row_id", "prompt_format", sr6("parsed_p").alias("parsed_p"), "y_30d")


@query("semi_restrict", _BASE + ", c as (select encounter_id as row_id, y_30d from cohort), "
       + _strat_sql("c", "row_id", "y_30d", "split", 0.15, _VR)
       + "\nselect row_id, prompt_format from responses where row_id in (select row_id from s2 where split = 'test')")
def q_semi_restrict(spark, sf):
    c = cohort_df(spark, sf, []).select("row_id", "y_30d")
    test = S.split_stratified(c, "row_id", "y_30d").where("split = 'test'")
    return view(spark, sf, "responses").join(test.select("row_id"), "row_id", "left_semi").select("row_id", "prompt_format")


@query("select_rows_by_ids", "select doc_id, lang from documents where doc_id in (select doc_id from labels)")
def q_select_rows_by_ids(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", "lang")
    return d.join(read_table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")


@query("seed_cache", _BASE + f"""
, c0 as (select row_id, prompt_format, response, {_STRICT} as parsed_p, 0 as pref from responses where {_STRICT} is not null),
c1 as (select row_id, prompt_format, response, {_LENIENT} as parsed_p, 1 as pref from responses),
u as (select * from c0 union all select * from c1),
own as (select * from u where row_id in (select encounter_id from cohort))
select row_id, prompt_format, response, {r6('parsed_p')} as parsed_p from (
  select *, row_number() over (partition by row_id, prompt_format order by pref) as rn from own) x where rn = 1""")
def q_seed_cache(spark, sf):
    own = cohort_df(spark, sf, []).select("row_id")
    c0 = parsed_responses(spark, sf).where("parsed_p is not null").select("row_id", "prompt_format", "response", "parsed_p")
    c1 = parsed_responses(spark, sf, strict=False).select("row_id", "prompt_format", "response", "parsed_p")
    s = SC.seed_cache(own, [c0, c1])
    return s.select("row_id", "prompt_format", "response", sr6("parsed_p").alias("parsed_p"))


@query("parse_coverage", _BASE + f"""
select f.fmt as prompt_format, count(*)::BIGINT as n, count(p)::BIGINT as n_valid, {r6('count(p) * 1.0e0 / count(*)')} as coverage
from cohort co cross join (select 'structured' as fmt union all select 'natural' union all select 'abbreviated') f
left join (select row_id, prompt_format, {_STRICT} as p from responses where row_id % 3 <> 0) x on x.row_id = co.encounter_id and x.prompt_format = f.fmt
group by f.fmt""")
def q_parse_coverage(spark, sf):
    """Coverage of the cohort's requests by a cache that lacks every third encounter."""
    requests = cohort_df(spark, sf, []).select("row_id", F.explode(F.array(*[F.lit(x) for x in PROMPT_FORMATS])).alias("prompt_format"))
    return SC.parse_coverage(parsed_responses(spark, sf).where("row_id % 3 <> 0"), requests)


_REPORT_BASE = ("select r.prompt_format, " + _STRICT.replace("response", "r.response")
                + " as score, coalesce(cast(e.readmitted = '<30' as int), 0) as y "
                  "from responses r join encounters e on r.row_id = e.encounter_id")


def _score_report_sql():
    inner = sqlgen.delong(_REPORT_BASE, ["prompt_format"], prefix=",")
    return (cte("encounters", "responses")
            + inner.replace("\nselect prompt_format, n::BIGINT", ",\nres as (select prompt_format, n::BIGINT", 1)
            + f""")
select c.prompt_format, c.n_valid, {r6('c.n_valid * 1.0e0 / c.n')} as coverage,
  case when c.n_valid >= 100 then res.auc end as auc, case when c.n_valid >= 100 then res.ci_lo end as ci_lo,
  case when c.n_valid >= 100 then res.ci_hi end as ci_hi
from (select prompt_format, count(*)::BIGINT as n, count(score)::BIGINT as n_valid from ({_REPORT_BASE}) b group by prompt_format) c
left join res on c.prompt_format = res.prompt_format""")


def score_report(cache, labels, min_valid: int = 100, group=("prompt_format",)):
    """dedupe-free cache -> align labels -> coverage + guarded AUC per group, one job."""
    j = cache.select(*group, "row_id", "parsed_p").join(labels, "row_id")
    # one aggregation of the joined data; coverage and AUC both read the tie table
    from riskloom.session import cut_lineage
    # the tie table (groups x distinct scores) feeds coverage and the DeLong
    # prefix sums; cut lineage once so the parse + join runs a single time
    ties = cut_lineage(M.tie_table_with_missing(j, list(group), "parsed_p", "y_30d"))
    n_all = F.col("pos") + F.col("neg")
    cov = ties.groupBy(*group).agg(F.sum(n_all).alias("n"),
                                   F.sum(F.when(F.col("score").isNotNull(), n_all).otherwise(0)).alias("n_valid"))
    auc = M.auc_delong_ties(ties.where(F.col("score").isNotNull()), list(group)).select(*group, "auc", "ci_lo", "ci_hi")
    r = cov.join(auc, list(group), "left")
    ok = F.col("n_valid") >= min_valid
    return r.select(*group, "n_valid", sr6(F.col("n_valid") / F.col("n")).alias("coverage"),
                    F.when(ok, F.col("auc")).alias("auc"), F.when(ok, F.col("ci_lo")).alias("ci_lo"),
                    F.when(ok, F.col("ci_hi")).alias("ci_hi"))


@query("score_report", _score_report_sql())
def q_score_report(spark, sf):
    return score_report(parsed_responses(spark, sf), _labels(spark, sf))


def _guard_sql():
    base = _REPORT_BASE.replace("select r.prompt_format,", "select r.prompt_format, r.chunk_id,")
    inner = sqlgen.delong(base, ["prompt_format", "chunk_id"], prefix=",")
    return (cte("encounters", "responses")
            + inner.replace("\nselect prompt_format, chunk_id, n::BIGINT", ",\nres as (select prompt_format, chunk_id, n::BIGINT", 1)
            + f""")
select c.prompt_format, c.chunk_id, c.n_valid,
  case when c.n_valid >= 100 then res.auc end as auc
from (select prompt_format, chunk_id, count(score)::BIGINT as n_valid from ({base}) b group by prompt_format, chunk_id) c
left join res on c.prompt_format = res.prompt_format and c.chunk_id = res.chunk_id""")


@query("guard_min_valid", _guard_sql())
def q_guard_min_valid(spark, sf):
    r = score_report(parsed_responses(spark, sf), _labels(spark, sf), group=("prompt_format", "chunk_id"))
    return r.select("prompt_format", "chunk_id", "n_valid", "auc")
