"""Mixing sources to target weights by temperature.

A source's share ``p`` of all tokens becomes a weight in proportion to
``p ** t``. The exponent ``t`` is bisected until the weights meet a target: an
entropy (nats), or the least flattening limit such that no source is repeated
more than ``max_repeats`` times within the token budget. Each round evaluates a
grid of exponents in one aggregation over the sources, so only the grid's sums
reach the driver, however many sources there are.

The weights are then realised as budgeted block permutations. A source with
weight ``w`` fills ``w * budget`` tokens with passes over its documents; every
pass is a fresh permutation by a keyed hash, and the last one stops with the
document that reaches the quota. The stream is dealt into blocks of about
``block_tokens`` tokens; each block holds every source by its weight, and is
itself permuted by the hash ``order``.

Running token sums of a pass are taken in two steps, by hash range and within
it, so a source of any size is spread over tasks. Documents without tokens (null
or empty texts) aren't scheduled, and a source of such documents has no weight.
A null source is the source ``""``. Repeated rows are scheduled each. An empty
table gives no rows. If the budget exceeds ``max_repeats`` times the tokens,
natural shares (``t = 1``) are kept.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.exprs import SPACE
from riskloom.llm.packed import keys
from riskloom.llm.shared import stored

GRID, ROUNDS = 32, 7
MAX_REPEATS, BLOCK_TOKENS = 1.25, 1 << 18
STEEPEST = 32.0
RANGE_ROWS = 1 << 13  # documents in a hash range, about
SEED = 11


def _sums(sources: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """For each exponent, the sums of ``p ** t`` and of ``p ** t * log p``."""
    row = sources.agg(*[c for i, t in enumerate(exponents) for c in (
        F.sum(F.pow("p", F.lit(t))).alias(f"z{i}"), F.sum(F.pow("p", F.lit(t)) * F.log("p")).alias(f"a{i}"))]).first()
    return [(row[f"z{i}"], row[f"a{i}"]) for i in range(len(exponents))]


def exponent(sources: DataFrame, budget_share: float, target_entropy: float | None = None, max_repeats: float | None = None) -> float:
    """The exponent that meets the target; ``sources`` has the shares ``p``, which must be positive."""
    least = sources.agg(F.min("p")).first()[0]

    def low_enough(t: float, z: float, a: float) -> bool:  # false below the answer, true from it on
        if target_entropy is not None:
            return math.log(z) - t * a / z <= target_entropy
        return least ** (t - 1) / z * budget_share <= max_repeats + 1e-12

    lo, hi = 0.0, (STEEPEST if target_entropy is not None else 1.0)
    for _ in range(ROUNDS):
        grid = [lo + (hi - lo) * k / GRID for k in range(GRID + 1)]
        ok = [low_enough(t, z, a) for t, (z, a) in zip(grid, _sums(sources, grid), strict=True)]
        first = next((k for k, x in enumerate(ok) if x), None)
        if first is None:
            return hi
        if first == 0:
            return lo
        lo, hi = grid[first - 1], grid[first]
    return hi


def weights(counted: DataFrame, budget: float | None = None, target_entropy: float | None = None,
            max_repeats: float | None = MAX_REPEATS) -> tuple[DataFrame, float, float]:
    """``(source, tokens, p, weight, quota)`` from rows ``(source, tokens)``; the exponent; the budget."""
    totals = stored(counted.groupBy("source").agg(F.sum("tokens").alias("tokens")).where("tokens > 0"), "sources")
    total = totals.agg(F.sum("tokens")).first()[0] or 0
    budget = float(total if budget is None else budget)
    shares = totals.withColumn("p", F.col("tokens") / F.lit(float(total or 1)))
    if not total:
        return shares.withColumn("weight", F.lit(0.0)).withColumn("quota", F.lit(0.0)), 1.0, budget
    t = exponent(shares, budget / total, target_entropy, None if target_entropy is not None else max_repeats)
    z = _sums(shares, [t])[0][0]
    out = shares.withColumn("weight", F.pow("p", F.lit(t)) / F.lit(z))
    return out.withColumn("quota", F.col("weight") * F.lit(budget)), t, budget


def word_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE[1:]}+")), F.lit(0)).cast("long")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", tokens: Column | None = None,
          budget: float | None = None, target_entropy: float | None = None, max_repeats: float | None = MAX_REPEATS,
          block_tokens: int = BLOCK_TOKENS, seed: int = SEED) -> DataFrame:
    """The schedule: a row for each use of a document, ``(id, source, n_tokens, weight, epoch, block, order)``.

    Within a block, rows are read by ``order``. ``tokens`` counts a document's
    tokens; by default its words. The budget is all tokens unless given.
    """
    counted = tokens if tokens is not None else word_tokens(F.col(f"`{text_col}`").cast("string"))
    slim = stored(docs.select(F.col(f"`{id_col}`").alias("__own"), *keys(id_col, text_col),
                              F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("")).alias("source"), counted.cast("long").alias("tokens"))
                  .where("tokens > 0"), "tokens")
    plan, _, budget = weights(slim.select("source", "tokens"), budget, target_entropy, max_repeats)
    blocks = max(1, math.ceil(budget / block_tokens))
    ranges = 1 << max(0, math.ceil(math.log2(max(1, slim.count() / RANGE_ROWS))))
    passes = plan.select("source", F.col("tokens").alias("pass_tokens"), "weight", "quota",
                         F.greatest(F.ceil(F.col("quota") / F.col("tokens")), F.lit(1)).cast("long").alias("passes"))
    uses = (slim.join(passes, "source")
            .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes") - 1)).alias("epoch"))
            .withColumn("order", F.xxhash64("__id", "__tk", "epoch", F.lit(seed)))
            .withColumn("range", F.pmod(F.shiftright("order", 24), F.lit(ranges))))
    part = ["source", "epoch", "range"]
    upto = Window.partitionBy("source", "epoch").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = (uses.groupBy(*part).agg(F.sum("tokens").alias("s"))
              .select(*part, F.coalesce(F.sum("s").over(upto), F.lit(0)).alias("earlier")))
    within = Window.partitionBy(*part).orderBy("order", "__id", "__tk").rowsBetween(Window.unboundedPreceding, -1)
    placed = (uses.join(before, part)
              .withColumn("at", F.col("epoch") * F.col("pass_tokens") + F.col("earlier") + F.coalesce(F.sum("tokens").over(within), F.lit(0)))
              .where("at < quota"))
    return placed.select(F.col("__own").alias(id_col), "source", F.col("tokens").alias("n_tokens"), "weight", "epoch",
                         F.floor(F.col("at") / F.col("quota") * blocks).alias("block"), F.xxhash64("order", F.lit(seed)).alias("order"))
