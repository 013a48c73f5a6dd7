"""Catalogued queries: leaderboards over the run log, model unions, paired evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions.stats import r6 as sr6
from riskloom.operators import leaderboard as LB
from riskloom.operators import metrics as M
from riskloom.operators import split as S
from riskloom.plans import sqlgen
from riskloom.plans.cohort_catalog import _COHORT, cohort_df
from riskloom.plans.registry import query, r6
from riskloom.plans.split_catalog import _sample_sql
from riskloom.sources.fixtures import cte, view

_RUNS = cte("runs") + """, rr as (select *, cast(substr(id, 6) as bigint) as seq,
  string_split(method, ' ')[-1] as phase from runs)
"""


def runs_df(spark, sf):
    r = view(spark, sf, "runs")
    return r.withColumn("seq", F.substring("id", 6, 1 << 20).cast("long")).withColumn(
        "phase", F.element_at(F.split("method", " "), -1))


@query("best_run", _RUNS + "select id, metric_value from rr where status = 'complete' and metric_value is not null "
       "order by metric_value desc, seq limit 1")
def q_best_run(spark, sf):
    return LB.best_run(runs_df(spark, sf))


@query("best_per_task", _RUNS + """, t as (select phase, count(*)::BIGINT as n_runs, sum(case when status = 'complete' then 1 else 0 end) as nc from rr group by phase),
bd as (select * from (select phase, id, coalesce(metric_value, 0.0e0) as m, row_number() over (partition by phase order by coalesce(metric_value, 0.0e0) desc, seq) as rn
  from rr where status = 'complete') x where rn = 1),
ba as (select * from (select phase, id, coalesce(metric_value, 0.0e0) as m, row_number() over (partition by phase order by coalesce(metric_value, 0.0e0) desc, seq) as rn
  from rr) x where rn = 1)
select t.phase, t.n_runs, case when t.nc > 0 then bd.id else ba.id end as best_id,
  case when t.nc > 0 then bd.m else ba.m end as best_metric
from t left join bd on t.phase = bd.phase left join ba on t.phase = ba.phase""")
def q_best_per_task(spark, sf):
    return LB.best_per_task(runs_df(spark, sf), "phase")


@query("rank_leaderboard", _RUNS + "select id, metric_value, rank() over (order by metric_value desc) as rank "
       "from rr where metric_value is not null")
def q_rank_leaderboard(spark, sf):
    r = LB.rank_leaderboard(runs_df(spark, sf))
    return r.select("id", "metric_value", F.col("rank").cast("long").alias("rank"))


_CELLS = """, cell as (select phase, cohort, max(metric_value) as best from rr where status = 'complete' and metric_value is not null group by phase, cohort)
"""


@query("axis_matrix", _RUNS + _CELLS + """select c.phase, c.cohort, c.best, c.best = m.cb as is_winner
from cell c join (select cohort, max(best) as cb from cell group by cohort) m on c.cohort = m.cohort""")
def q_axis_matrix(spark, sf):
    return LB.axis_matrix(runs_df(spark, sf), "phase", "cohort")


# declared in the order in which they were tried, not by name
_PHASES = ("STANDARD", "SMALL", "MEDIUM", "LARGE", "ECONOMY", "PROMO")
_AXES = {"tier": ("low", "mid", "high", "top"), "phase": _PHASES, "parity": ("even", "odd")}


def _place(column: str, values) -> str:
    return f"case {column} " + " ".join(f"when '{v}' then {i}" for i, v in enumerate(values)) + " end"


@query("section_winner", _RUNS + _CELLS + f"""select cohort, phase as winner, best from (
  select *, row_number() over (partition by cohort order by best desc, {_place('phase', _PHASES)}) as rn from cell) x where rn = 1""")
def q_section_winner(spark, sf):
    cells = LB.axis_matrix(runs_df(spark, sf), "phase", "cohort")
    return LB.section_winner(cells, "phase", "cohort", position=F.expr(_place("phase", _PHASES)))


_TIER = "case when seq % 7 = 0 then 'low' when seq % 7 < 4 then 'mid' else 'high' end"
_PARITY = "case when seq % 2 = 0 then 'even' else 'odd' end"


def _sections_sql(targets) -> str:
    """Every cell of the declared grid by a scalar subquery over the complete runs."""
    grid = [(t, v, a, i, x, j) for t in targets for v in _AXES[t] for i, (a, of) in enumerate((a, of) for a, of in _AXES.items() if a != t) for j, x in enumerate(of)]
    rows = ", ".join(repr(g) for g in grid)
    of = "case {} " + " ".join(f"when '{a}' then r.{a}" for a in _AXES) + " end"
    return _RUNS + f""", ax as (select id, metric_value, {_TIER} as tier, phase, {_PARITY} as parity from rr where status = 'complete' and metric_value is not null),
g as (select * from (values {rows}) v(target_axis, target_value, axis, axis_pos, value, value_pos)),
c as (select g.*, (select max(r.metric_value) from ax r where {of.format('g.target_axis')} = g.target_value and {of.format('g.axis')} = g.value) as best from g)
select *, case when best is null then 'deferred' else 'complete' end as status,
  coalesce(best = max(best) over (partition by target_axis, target_value, axis), false) as is_winner from c"""


@query("axis_sections", _sections_sql(["phase", "parity"]))
def q_axis_sections(spark, sf):
    """Two target axes, each over the other axes; no run has the tier 'top', so its cells are deferred."""
    r = runs_df(spark, sf)
    axes = F.create_map(F.lit("tier"), F.expr(_TIER), F.lit("phase"), F.col("phase"), F.lit("parity"), F.expr(_PARITY))
    return LB.axis_sections(r.withColumn("axes", axes), _AXES, ["phase", "parity", "no such axis"])


@query("phase_cohort_matrix", _RUNS + """select phase, cohort, metric_value from (
  select *, row_number() over (partition by phase, cohort order by seq desc) as rn from rr where status = 'complete') x where rn = 1""")
def q_phase_cohort_matrix(spark, sf):
    return LB.phase_cohort_matrix(runs_df(spark, sf), "phase", "cohort", "seq")


@query("topk_runs", _RUNS + """select * from (select id, metric_value, 'max' as objective from rr where status = 'complete' and metric_value is not null
  order by metric_value desc, id limit 3)
union all select * from (select id, metric_value, 'min' from rr where status = 'complete' and metric_value is not null order by metric_value asc, id limit 3)""")
def q_topk_runs(spark, sf):
    r = runs_df(spark, sf)
    a = LB.topk_runs(r, 3).select("id", "metric_value", F.lit("max").alias("objective"))
    b = LB.topk_runs(r, 3, objective="min").select("id", "metric_value", F.lit("min").alias("objective"))
    return a.unionByName(b)


@query("left_status", _RUNS + """select c.id, m.metric_value, case when m.metric_value is null then 'failed' else 'complete' end as status
from (select id from rr where status <> 'pending') c left join (select id, metric_value from rr where status = 'complete') m on c.id = m.id""")
def q_left_status(spark, sf):
    r = runs_df(spark, sf)
    return LB.left_status(r.where("status <> 'pending'"), r.where("status = 'complete'").select("id", "metric_value"))


@query("peer_delta", _RUNS + f""", c as (select * from rr where status = 'complete' and metric_value is not null),
p as (select a.id, a.phase, a.cohort, a.metric_value, b.cohort as peer_cohort, b.metric_value as pm,
  row_number() over (partition by a.id order by b.seq) as rn
  from c a join c b on a.phase = b.phase and a.cohort <> b.cohort)
select id, phase, cohort, peer_cohort, {r6('metric_value - pm')} as delta,
  case when metric_value - pm > 0 then 'better' else 'worse' end as verdict from p where rn = 1""")
def q_peer_delta(spark, sf):
    p = LB.peer_delta(runs_df(spark, sf), "phase", "cohort", "seq")
    return p.select("id", "phase", "cohort", "peer_cohort", sr6("delta").alias("delta"), "verdict")


_SLUGS = "concat('iter-', p_size, '_cand_', p_partkey + p_size % 3)"


@query("match_run_by_slug", _RUNS + f"""select s.slug, r.id, r.metric_value from (select {_SLUGS} as slug from part) s
join rr r on regexp_replace(s.slug, '^iter-\\d+_', '') = r.id""")
def q_match_run_by_slug(spark, sf):
    from riskloom.sources.tables import read_table
    s = read_table(spark, sf, "part").select(F.expr(_SLUGS).alias("slug"))
    r = runs_df(spark, sf)
    return s.join(r, LB.strip_iter_prefix("slug") == r["id"]).select("slug", "id", "metric_value")


@query("union_new_only", _RUNS + """, cur as (select id as config, metric_value from rr where status = 'complete'),
old as (select concat('cand ', seq + 1000 * (seq % 2)) as config, metric_value from rr)
select * from cur union all select * from old o
where replace(o.config, ' ', '_') not in (select config from cur) and o.config not in (select config from cur)""")
def q_union_new_only(spark, sf):
    from riskloom.functions.text import slugify_model
    r = runs_df(spark, sf)
    cur = r.where("status = 'complete'").select(F.col("id").alias("config"), "metric_value")
    old = r.select(F.concat(F.lit("cand "), (F.col("seq") + 1000 * (F.col("seq") % 2)).cast("string")).alias("config"),
                   "metric_value")
    return LB.union_new_only(cur, old, "config", slugify_model("config"))


_HP = """case seq % 3 when 0 then map(['penalty', 'C'], ['l1', cast(seq % 10 as varchar)])
 when 1 then map(['max_depth', 'n_estimators', 'learning_rate'], [cast(seq % 7 as varchar), cast(100 * (seq % 5) as varchar), '0.05'])
 else map(['hidden', 'alpha'], [case when seq % 2 = 0 then '64-32' else '128-64-32' end, '0.0001']) end"""


def _hp_spark():
    seq = F.col("seq")
    m0 = F.create_map(F.lit("penalty"), F.lit("l1"), F.lit("C"), (seq % 10).cast("string"))
    m1 = F.create_map(F.lit("max_depth"), (seq % 7).cast("string"), F.lit("n_estimators"),
                      (100 * (seq % 5)).cast("string"), F.lit("learning_rate"), F.lit("0.05"))
    m2 = F.create_map(F.lit("hidden"), F.when(seq % 2 == 0, "64-32").otherwise("128-64-32"), F.lit("alpha"), F.lit("0.0001"))
    return F.when(seq % 3 == 0, m0).when(seq % 3 == 1, m1).otherwise(m2)


@query("format_hparams", _RUNS + f"""select id, case when seq % 3 = 0 then 'penalty=l1, C=' || cast(seq % 10 as varchar)
 when seq % 3 = 1 then 'max_depth=' || cast(seq % 7 as varchar) || ', n_est=' || cast(100 * (seq % 5) as varchar) || ', lr=0.05'
 else 'hidden=(' || case when seq % 2 = 0 then '64, 32' else '128, 64, 32' end || '), alpha=0.0001' end as hparams from rr""")
def q_format_hparams(spark, sf):
    r = runs_df(spark, sf).withColumn("hp", _hp_spark())
    return r.select("id", LB.format_hparams("hp").alias("hparams"))


@query("pending_items", _RUNS + "select id, 'cohort=' || cohort || ', method=' || method as label from rr where status = 'pending'")
def q_pending_items(spark, sf):
    r = runs_df(spark, sf).where("status = 'pending'")
    m = F.create_map(F.lit("method"), F.col("method"), F.lit("cohort"), F.col("cohort"))
    return r.select("id", LB.map_label(m).alias("label"))


@query("hpo_wide", _RUNS + f""", w as (select id, metric_value as auc, {r6('metric_value - 0.6e0')} as gap, cast(seq as double) as seq from rr where status = 'complete'),
mx as (select max(auc) as ma, max(gap) as mg, max(seq) as ms from w)
select id, auc, gap, seq, coalesce(auc = ma, false) as best_auc, coalesce(gap = mg, false) as best_gap, coalesce(seq = ms, false) as best_seq
from w cross join mx""")
def q_hpo_wide(spark, sf):
    r = runs_df(spark, sf).where("status = 'complete'")
    kv = r.select("id", F.explode(F.array(
        F.struct(F.lit("auc").alias("key"), F.col("metric_value").alias("value")),
        F.struct(F.lit("gap").alias("key"), sr6(F.col("metric_value") - 0.6).alias("value")),
        F.struct(F.lit("seq").alias("key"), F.col("seq").cast("double").alias("value")))).alias("kv")).select("id", "kv.*")
    return LB.hpo_wide(kv, keys=["auc", "gap", "seq"])


# ---- model unions / paired evaluation on the cohort --------------------------

_MODELS = ("number_inpatient", "num_medications", "number_emergency")
_BASE = cte("encounters") + "," + _COHORT


def _union_models(c):
    out = None
    for m in _MODELS:
        x = c.select("row_id", "y_30d", F.lit(m).alias("model"), F.col(m).cast("double").alias("score"))
        out = x if out is None else out.unionByName(x)
    return out


_UNION_SQL = " union all ".join(f"select encounter_id as row_id, y_30d, '{m}' as model, cast({m} as double) as score from cohort" for m in _MODELS)


@query("union_all_models", _BASE + _UNION_SQL)
def q_union_all_models(spark, sf):
    return _union_models(cohort_df(spark, sf, list(_MODELS)))


@query("blend_mean", _BASE + f", u as ({_UNION_SQL}) select row_id, {r6('avg(score)')} as blend from u group by row_id having count(score) = 3")
def q_blend_mean(spark, sf):
    u = _union_models(cohort_df(spark, sf, list(_MODELS)))
    g = u.groupBy("row_id").agg(F.avg("score").alias("blend"), F.count("score").alias("_k"))
    return g.where(F.col("_k") == len(_MODELS)).select("row_id", sr6("blend").alias("blend"))


def _paired_sql():
    samp = _sample_sql(_BASE + ", src as (select encounter_id as row_id, y_30d from cohort)", "row_id", "y_30d", 300, False)
    # wrap: sampled ids -> union of models restricted to them -> grouped DeLong
    base = (f"select u.model, u.score, u.y_30d as y from ({_UNION_SQL.replace('from cohort', 'from cohort')}) u "
            f"where u.row_id in (select row_id from sampled)")
    return (samp.replace("\nselect row_id, y_30d from k where", ", sampled as (select row_id, y_30d from k where", 1)
            + ")" + sqlgen.delong(base, ["model"], prefix=","))


@query("paired_subsample_eval", _paired_sql())
def q_paired_subsample_eval(spark, sf):
    c = cohort_df(spark, sf, list(_MODELS))
    sample = S.sample_stratified_n(c.select("row_id", "y_30d"), "row_id", "y_30d", 300)
    u = _union_models(c).join(sample.select("row_id"), "row_id", "left_semi")
    return M.auc_delong(u, ["model"], "score", "y_30d")
