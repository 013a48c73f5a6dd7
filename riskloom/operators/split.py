"""Reproducible splits, folds, samples and chunks from keyed hashes.

Row membership depends only on (key, seed, purpose), so results are identical
for any partitioning and survive task retries. Every "first k by hash within
a stratum" is computed with ``ranking.hash_rank`` (two-level, no single-task
window), and stratum sizes come from the same pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.hashing import keyed_hash
from riskloom.functions.vocab import SPLIT_SEED
from riskloom.operators.ranking import hash_rank, order_rank


def _round_half_up(x: Column) -> Column:
    return F.floor(x + F.lit(0.5)).cast("long")


def split_stratified(df: DataFrame, key: str, label: str, *, test: float = 0.15,
                     val_of_rest: float = 0.15 / 0.85, seed: int = SPLIT_SEED,
                     purpose: str = "split", out: str = "split") -> DataFrame:
    """train / val / test per label stratum.

    Per stratum of size n: ``n_test = round(n * test)``, then
    ``n_val = round((n - n_test) * val_of_rest)``; rows are taken in keyed-hash
    order (key as tie-break).
    """
    x = df.withColumn("_h", keyed_hash(key, seed=seed, purpose=purpose))
    r = hash_rank(x, [label], "_h", [key])
    n_test = _round_half_up(F.col("_n") * F.lit(test))
    n_val = _round_half_up((F.col("_n") - n_test) * F.lit(val_of_rest))
    s = (F.when(F.col("_rank") <= n_test, "test")
          .when(F.col("_rank") <= n_test + n_val, "val").otherwise("train"))
    return r.withColumn(out, s).drop("_h", "_rank", "_n")


def split_group(df: DataFrame, group: str, *, test: float = 0.15, val: float = 0.15,
                seed: int = SPLIT_SEED, purpose: str = "group_split", out: str = "split") -> DataFrame:
    """Group-safe split: whole groups go to one side.

    Distinct groups are hash-ranked once (``floor(n_groups * frac)`` each for
    test and val), then joined back; the group table is one row per group, and
    AQE splits a skewed hot group's partition on the big side.
    """
    g = df.select(group).where(F.col(group).isNotNull()).distinct()
    g = g.withColumn("_h", keyed_hash(group, seed=seed, purpose=purpose))
    r = hash_rank(g, [], "_h", [group])
    n_test = F.floor(F.col("_n") * F.lit(test)).cast("long")
    n_val = F.floor(F.col("_n") * F.lit(val)).cast("long")
    s = (F.when(F.col("_rank") <= n_test, "test")
          .when(F.col("_rank") <= n_test + n_val, "val").otherwise("train"))
    gs = r.select(group, s.alias(out))
    return df.join(gs, group, "left").fillna({out: "train"})


def kfold_stratified(df: DataFrame, key: str, label: str, k: int = 5, *, seed: int = SPLIT_SEED,
                     purpose: str = "kfold", out: str = "fold") -> DataFrame:
    """fold = (rank in label stratum by hash - 1) mod k: balanced labels per fold."""
    x = df.withColumn("_h", keyed_hash(key, seed=seed, purpose=purpose))
    r = hash_rank(x, [label], "_h", [key])
    return r.withColumn(out, F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int")).drop("_h", "_rank", "_n")


def kfold_stratified_group(df: DataFrame, group: str, label: str, k: int = 5, *, key: str | None = None,
                           seed: int = SPLIT_SEED, purpose: str = "group_kfold",
                           out: str = "fold") -> DataFrame:
    """Folds where a group never straddles folds, balanced in positives and rows.

    Groups are summarised (map-side combined), ordered by positives, then rows, both
    descending, then hash, and dealt in snake order (0 1 2 2 1 0 ..). So no two
    folds differ by more positives than twice the largest group's, nor, among groups of equally many positives,
    by more rows than twice the largest of them. The place of a group is the
    number of groups in larger size classes, from a table of the classes, and its
    hash rank in its own class. A row without a group is a group of its own: such rows are
    dealt out by label (in order of the hash of ``key``, else of all columns).
    """
    known = df.where(F.col(group).isNotNull())
    g = known.groupBy(group).agg(F.sum(F.col(label).cast("long")).alias("_pos"), F.count(F.lit(1)).alias("_rows"))
    g = g.withColumn("_pos", F.coalesce("_pos", F.lit(0))).withColumn("_h", keyed_hash(group, seed=seed, purpose=purpose))
    larger = Window.orderBy(F.desc("_pos"), F.desc("_rows")).rowsBetween(Window.unboundedPreceding, -1)
    classes = g.groupBy("_pos", "_rows").agg(F.count(F.lit(1)).alias("_groups"))
    classes = classes.select("_pos", "_rows", F.coalesce(F.sum("_groups").over(larger), F.lit(0)).alias("_before"))
    r = hash_rank(g, ["_pos", "_rows"], "_h", [group]).join(classes, ["_pos", "_rows"])
    place = F.col("_before") + F.col("_rank") - 1
    turn = F.pmod(place, F.lit(k))
    gf = r.select(group, F.when(F.floor(place / k) % 2 == 0, turn).otherwise(k - 1 - turn).cast("int").alias(out))
    alone = df.where(F.col(group).isNull())
    if key is None:
        h = F.pmod(F.xxhash64(*df.columns), F.lit(1 << 32))
        alone = hash_rank(alone.withColumn("_h", h), [label], "_h", [])
    else:
        alone = hash_rank(alone.withColumn("_h", keyed_hash(key, seed=seed, purpose=purpose)), [label], "_h", [key])
    alone = alone.withColumn(out, F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int"))
    return known.join(gf, group).select(*df.columns, out).unionByName(alone.select(*df.columns, out))


def sample_stratified_n(df: DataFrame, key: str, label: str, n_rows: int, *,
                        seed: int = SPLIT_SEED, purpose: str = "sample",
                        keep_all_if_larger: bool = False) -> DataFrame:
    """Exactly ``n_rows`` rows without replacement, positives first:
    ``min(floor(n_rows * rate) + 1, n_pos)`` positives, the rest negatives.

    With ``keep_all_if_larger`` a request of at least the table size returns
    the whole table (the training-subset variant).
    """
    x = df.withColumn("_h", keyed_hash(key, seed=seed, purpose=purpose))
    r = hash_rank(x, [label], "_h", [key])
    from riskloom.functions.stats import one_row
    tot = one_row(df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("p")))
    r = r.withColumn("_tot_n", tot["n"]).withColumn("_tot_p", tot["p"])
    k_pos = F.least(F.floor(F.lit(n_rows) * F.col("_tot_p") / F.col("_tot_n")).cast("long") + 1, F.col("_tot_p"))
    take = F.when(F.col(label) == 1, k_pos).otherwise(F.lit(n_rows) - k_pos)
    keep = F.col("_rank") <= take
    if keep_all_if_larger:
        keep = keep | (F.lit(n_rows) >= F.col("_tot_n"))
    return r.where(keep).drop("_h", "_rank", "_n", "_tot_n", "_tot_p")


def chunk_assign(df: DataFrame, order_col: str, k: int, *, out: str = "chunk_id") -> DataFrame:
    """Contiguous chunks by ``order_col`` with bounds floor(i * n / k).

    Row of 1-based rank r goes to chunk ceil(r * k / n) - 1. The rank is the
    distributed order rank, so no task sees more than one bucket of rows.
    """
    r = order_rank(df, [], order_col)
    c = F.floor((F.col("_rank") * F.lit(k) + F.col("_n") - 1) / F.col("_n")).cast("long") - 1
    return r.withColumn(out, c.cast("int")).drop("_rank", "_n")


def complement_ids(all_ids: DataFrame, *taken: DataFrame, key: str) -> DataFrame:
    """Rows of ``all_ids`` whose key is in none of ``taken`` (anti joins)."""
    out = all_ids
    for t in taken:
        out = out.join(t.select(key), key, "left_anti")
    return out
