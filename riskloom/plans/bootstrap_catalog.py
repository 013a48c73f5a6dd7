"""Catalogued queries: bootstrap AUC interval, DeLong with bootstrap fallback, ROC band."""

from __future__ import annotations

from riskloom.operators import bootstrap as B
from riskloom.plans import sqlgen
from riskloom.plans.cohort_catalog import labelled_docs
from riskloom.plans.registry import query, r6
from riskloom.sources.tables import read_table


def _base(label: str, group: str = "") -> str:
    return (f"base as (select l.doc_id as k, {group and f'd.{group}, '}cast(d.n_chars as double) as score, l.{label} as y "
            "from labels l join documents d on l.doc_id = d.doc_id where d.n_chars is not null and l." + label + " is not null)")


def _replicates_sql(base: str, n_boot: int, g: str = "") -> str:
    """CTEs up to ``a``: each replicate's AUC of CTE ``base``."""
    by = f"{g}, rep" if g else "rep"
    return f"""{B.sql_weight_ctes(base, 'k', n_boot)},
wt as (select {by}, score, sum(w * y)::BIGINT as pos, sum(w * (1 - y))::BIGINT as neg from wx group by {by}, score),
wp as (select *, coalesce(sum(neg) over (partition by {by} order by score rows between unbounded preceding and 1 preceding), 0) as neg_below,
  sum(pos) over (partition by {by}) as pos_total, sum(neg) over (partition by {by}) as neg_total from wt),
a as (select {by}, case when max(pos_total) > 0 and max(neg_total) > 0
  then sum(pos * (2 * neg_below + neg)) / 2.0e0 / (max(pos_total) * 1.0e0 * max(neg_total)) end as auc from wp group by {by}),
ci as (select {g and f'{g}, '}{r6('quantile_cont(auc, 0.025)')} as ci_lo, {r6('quantile_cont(auc, 0.975)')} as ci_hi,
  count(*)::BIGINT as n_boot_used from a where auc is not null {g and f'group by {g}'})"""


def _boot_sql(n_boot: int) -> str:
    point = sqlgen.delong("select d.n_chars as score, l.quality as y from labels l join documents d on l.doc_id = d.doc_id")
    return f"""with {_base('quality')}, {_replicates_sql('base', n_boot)}
select p.auc, ci.ci_lo, ci.ci_hi, ci.n_boot_used from ({point}) p cross join ci"""


@query("auc_bootstrap_ci", _boot_sql(B.AUC_REPLICATES))
def q_auc_bootstrap_ci(spark, sf):
    return B.auc_bootstrap_ci(labelled_docs(spark, sf), "doc_id", "n_chars", "quality")


def _fallback_sql(n_boot: int) -> str:
    exact = sqlgen.delong("select d.source, d.n_chars as score, l.toxic as y from labels l join documents d on l.doc_id = d.doc_id where d.source is not null", ["source"])
    return f"""with {_base('toxic', 'source')},
lone as (select base.* from base join (select source from base where source is not null group by source having least(sum(y), sum(1 - y)) = 1) c on base.source = c.source),
{_replicates_sql('lone', n_boot, 'source')}
select d.source, d.n, d.n_pos, d.auc, coalesce(d.ci_lo, ci.ci_lo) as ci_lo, coalesce(d.ci_hi, ci.ci_hi) as ci_hi,
  case when d.ci_lo is not null then 'delong' when ci.ci_lo is not null then 'bootstrap' else 'none' end as method,
  coalesce(ci.n_boot_used, 0)::BIGINT as n_boot_used
from ({exact}) d left join ci on d.source = ci.source"""


@query("auc_ci_fallback", _fallback_sql(B.FALLBACK_REPLICATES))
def q_auc_ci_fallback(spark, sf):
    """Each source's AUC of text length for toxicity: DeLong, or the bootstrap where a source has a single toxic document."""
    docs = read_table(spark, sf, "documents").select("doc_id", "source", "n_chars").where("source is not null")
    docs = read_table(spark, sf, "labels").select("doc_id", "toxic").join(docs, "doc_id")
    return B.auc_ci(docs, "doc_id", "n_chars", "toxic", group_cols=["source"])


def _band_sql(n_boot: int, steps: int = 100) -> str:
    return f"""with {_base('quality')}, {B.sql_weight_ctes('base', 'k', n_boot)},
wt as (select rep, score, sum(w * y)::BIGINT as pos, sum(w * (1 - y))::BIGINT as neg from wx group by rep, score),
wp as (select rep, (sum(pos) over up - pos)::BIGINT as tp0, (sum(pos) over up)::BIGINT as tp1, (sum(neg) over up - neg)::BIGINT as fp0, (sum(neg) over up)::BIGINT as fp1,
  (sum(pos) over (partition by rep))::BIGINT as pp, (sum(neg) over (partition by rep))::BIGINT as nn
  from wt window up as (partition by rep order by score desc rows unbounded preceding)),
seg as (select rep, tp0 * 1.0e0 / pp as y0, tp1 * 1.0e0 / pp as y1, fp0 * 1.0e0 / nn as x0, fp1 * 1.0e0 / nn as x1,
  unnest(range((fp0 * {steps} + nn - 1) // nn, fp1 * {steps} // nn + 1)) as gi from wp where pp > 0 and nn > 0),
per as (select rep, gi, case when gi = 0 then 0.0e0 else max(case when x1 > x0 then y0 + (y1 - y0) * (gi / {float(steps)}e0 - x0) / (x1 - x0) else y1 end) end as tpr
  from seg group by rep, gi)
select gi / {float(steps)}e0 as fpr, {r6('quantile_cont(tpr, 0.025)')} as tpr_lo, {r6('quantile_cont(tpr, 0.975)')} as tpr_hi, {r6('avg(tpr)')} as tpr_mean
from per group by gi"""


@query("roc_band_bootstrap", _band_sql(B.BAND_REPLICATES))
def q_roc_band_bootstrap(spark, sf):
    return B.roc_band_bootstrap(labelled_docs(spark, sf), "doc_id", "n_chars", "quality")
