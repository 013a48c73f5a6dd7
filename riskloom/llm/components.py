"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.shared import scratch, stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (``large``) or smaller neighbours and itself to its least neighbour."""
    if large:
        near = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    linked = near.join(least, "u")
    if large:
        return linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    return (linked.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.where("u <> m").select("u", F.col("m").alias("v"))).distinct())


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``edges`` (longs ``a``, ``b``), the label being the component's least node.

    Rounds grow with the logarithm of a component's diameter. Each round is
    written to the shared folder; only its row count and a checksum reach the
    driver.
    """
    with scratch(edges.sparkSession) as keep:
        now = _converged(edges)
        keep(now)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)


def _converged(edges: DataFrame) -> DataFrame:
    """Edges ``(u, v)`` from every node to its component's least node."""
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    while True:
        now = stored(_star(_star(now, True), False), "stars")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            return now
        seen = state
