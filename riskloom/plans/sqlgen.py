"""DuckDB text generators for the oracle side of metric queries.

These are plain single-node SQL (global windows are fine for an oracle);
the Spark side uses the distributed two-level plan instead.
"""

from __future__ import annotations

from riskloom.functions.vocab import Z95
from riskloom.plans.registry import r6


def _g(g):
    return "".join(f"{c}, " for c in g)


def tie_prefix_ctes(base: str, g=()) -> str:
    """CTEs ``t`` (tie table) and ``tp`` (with below/total sums) over ``base(g.., score, y)``."""
    pb = f"partition by {', '.join(g)}" if g else ""
    w = f"({pb} order by score rows between unbounded preceding and 1 preceding)"
    return f"""t as (select {_g(g)}score, sum(y)::BIGINT as pos, sum(1 - y)::BIGINT as neg
  from (select {_g(g)}cast(score as double) as score, cast(y as int) as y from ({base}) b0) b
  where score is not null and y is not null and not isnan(score) group by {_g(g)}score),
tp as (select *, coalesce(sum(pos) over {w}, 0) as pos_below, coalesce(sum(neg) over {w}, 0) as neg_below,
  sum(pos) over ({pb}) as pos_total, sum(neg) over ({pb}) as neg_total from t)"""


def delong(base: str, g=(), z: float = Z95, prefix: str = "with ") -> str:
    gb = f"group by {', '.join(g)}" if g else ""
    return prefix + tie_prefix_ctes(base, g) + f""",
s as (select {_g(g)}sum(pos + neg) as n, max(pos_total) * 1.0e0 as pp, max(neg_total) * 1.0e0 as nn,
  sum(pos * (neg_below + neg / 2.0e0) / neg_total) as spa,
  sum(pos * ((neg_below + neg / 2.0e0) / neg_total) * ((neg_below + neg / 2.0e0) / neg_total)) as spa2,
  sum(neg * ((pos_total - pos_below - pos + pos / 2.0e0) / pos_total) * ((pos_total - pos_below - pos + pos / 2.0e0) / pos_total)) as sna2
  from tp {gb}),
a as (select *, case when pp > 0 and nn > 0 then spa / pp end as auc from s),
v as (select *, case when pp >= 2 and nn >= 2 then (spa2 - pp * auc * auc) / (pp - 1) / pp + (sna2 - nn * auc * auc) / (nn - 1) / nn end as var from a)
select {_g(g)}n::BIGINT as n, pp::BIGINT as n_pos, {r6('auc')} as auc,
  {r6(f'case when var is not null then greatest(auc - {z!r} * sqrt(greatest(var, 0)), 0) end')} as ci_lo,
  {r6(f'case when var is not null then least(auc + {z!r} * sqrt(greatest(var, 0)), 1) end')} as ci_hi
from v"""


def roc(base: str, g=(), prefix: str = "with ") -> str:
    return prefix + tie_prefix_ctes(base, g) + f"""
select {_g(g)}score as threshold, (pos_total - pos_below)::BIGINT as tp, (neg_total - neg_below)::BIGINT as fp,
  pos_total::BIGINT as pos_total, neg_total::BIGINT as neg_total,
  {r6('(neg_total - neg_below) * 1.0e0 / neg_total')} as fpr, {r6('(pos_total - pos_below) * 1.0e0 / pos_total')} as tpr
from tp"""
