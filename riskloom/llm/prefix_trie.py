"""Conversation prefix trie by whole-sequence collapse.

1. Every turn is known by a 128-bit hash of its role and text; texts don't
   travel. A sequence of turns is known by the sum of hashes of (place, turn)
   in four lanes of 32 bits, so the key of each prefix is a running sum, and no
   conversation has to fit a task.
2. *Collapse.* Identical conversations become one sequence with a weight, a
   representative (the smallest id) and a list of the conversations that end there,
   in pieces of ``PIECE`` ids in ascending order.
3. *Leaves* are the sequences that an anti join with all proper prefixes leaves.
4. *Prefixes* of the representatives, with the weights, are aggregated to nodes.
   A node's ``conv_id`` is the smallest conversation through it. The nodes of one
   ``conv_id`` are a downward path, so every path's sum is taken once and
   added to the nodes above its top: a subtree's sum costs one row for each
   prefix, whatever the depth.

Turns are ordered by ``turn`` (null first), ties by the hash of role and text.
A null role or text is empty. Rows without a conversation id (null, or no
integer) belong to no conversation. Repeated rows are turns of their own. An
empty table has no nodes, not even a root. Other columns are left alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.running import running
from riskloom.llm.shared import scratch, stored

PIECE = 4096
LANES = ["l0", "l1", "l2", "l3"]
NODE = ["k1", "k2"]


def numbered(talks: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Turns as (conv_id, pos from 0, turn hash, code points of the text)."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    slim = talks.select(F.col(f"`{id_col}`").try_cast("long").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
                        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("said"), F.length(text).cast("long").alias("chars"))
    slim = stored(slim.where("conv_id is not null").withColumn("one", F.lit(1).cast("long")), "turns")
    return running(slim, ["conv_id"], ["turn", "said"], {"n": "one"}, "numbered-turns").select("conv_id", (F.col("n") - 1).alias("pos"), "said", "chars")


def rebuilt(turns: DataFrame, of: Column, first: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Each conversation's own turns after its first ``first``, behind as many turns of conversation ``of``.

    ``turns`` as of ``numbered``, stored; ``first`` is at most ``most``. Gives the
    turns and the ids of all conversations, also of those left without a turn.
    """
    heads = turns.where(F.col("pos") < most)
    convs = turns.where("pos = 0").select("conv_id", of.alias("base"), first.alias("h"))
    had = heads.groupBy(F.col("conv_id").alias("base")).agg(F.count(F.lit(1)).alias("had"))
    own = (turns.withColumn("base", of).withColumn("h", first).where("pos >= h").join(had, "base", "left")
           .withColumn("pos", F.col("pos") - F.col("h") + F.least("h", F.coalesce("had", F.lit(0)))))
    lent = heads.withColumnRenamed("conv_id", "base").join(convs, "base").where("pos < h")
    columns = ["conv_id", "pos", "said", "chars"]
    return own.select(*columns).unionByName(lent.select(*columns)), convs.select("conv_id")


def _lanes() -> list[Column]:
    placed = F.md5(F.concat(F.col("pos").cast("string"), F.lit(":"), F.col("said")).cast("binary"))
    return [F.conv(F.substring(placed, 1 + 8 * i, 8), 16, 10).cast("long").alias(c) for i, c in enumerate(LANES)]


def _key(lanes: list[str]) -> list[Column]:
    low = F.lit(0xFFFFFFFF)
    return [(F.shiftleft(F.col(a).bitwiseAND(low), 32).bitwiseOR(F.col(b).bitwiseAND(low))).alias(k) for k, a, b in zip(NODE, lanes[::2], lanes[1::2], strict=True)]


def _piece_rows(size: int):
    """Rows (k1, k2, conv_id) in this order to lists of at most ``size`` ids of one key."""
    def run(batches):
        for b in batches:
            k1, k2, ids = (b.column(i).to_numpy() for i in range(3))
            new = np.ones(len(ids), bool)
            new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
            begin = np.maximum.accumulate(np.where(new, np.arange(len(ids)), 0))
            new |= (np.arange(len(ids)) - begin) % size == 0
            at = np.flatnonzero(new)
            lists = pa.ListArray.from_arrays(pa.array(np.append(at, len(ids)).astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([pa.array(k1[at]), pa.array(k2[at]), pa.array(ids[at]), lists], names=["k1", "k2", "first", "ids"])
    return run


def digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the comma-joined decimal ids of each key, its pieces streamed in order."""
    def run(batches):
        key, state = None, None
        for b in batches:
            out = []
            for k1, k2, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist(), strict=True):
                said = ",".join(map(str, ids)).encode()
                if (k1, k2) == key:
                    state.update(b"," + said)
                else:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = (k1, k2), hashlib.sha256(said)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=["k1", "k2", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]]), pa.array([state.hexdigest()])], names=["k1", "k2", "ends_sha256"])

    dealt = ends.select("k1", "k2", "first", "ids").repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first")
    return dealt.mapInArrow(run, "k1 long, k2 long, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame, piece: int = PIECE) -> tuple[DataFrame, DataFrame]:
    """Nodes, and the end lists in pieces (k1, k2, first, ids), both stored.

    ``turns`` has (conv_id, pos from 0 without gaps, said, chars), ``convs`` every
    conversation once. Nodes have ``k1, k2, depth, conv_id, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens``; conversation ``conv_id``'s turn
    ``depth`` is the node's last.
    """
    with scratch(turns.sparkSession) as keep:
        turns = stored(turns.select("conv_id", "pos", "chars", *_lanes()), "placed-turns")
        none = [F.lit(0).cast("long").alias(c) for c in LANES]
        wholes = stored(turns.select("conv_id", *LANES, F.lit(1).cast("long").alias("n"))
                        .unionByName(convs.select("conv_id", *none, F.lit(0).cast("long").alias("n")))
                        .groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in LANES], F.sum("n").alias("n"))
                        .select("conv_id", "n", *_key(LANES)), "whole-conversations")
        ends = stored(wholes.select("k1", "k2", "conv_id").repartitionByRange("k1", "k2", "conv_id").sortWithinPartitions("k1", "k2", "conv_id")
                      .mapInArrow(_piece_rows(piece), "k1 long, k2 long, first long, ids array<long>"), "ends")
        sequences = stored(wholes.groupBy(*NODE).agg(F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("rep"), F.max("n").alias("n")), "sequences")

        mine = turns.join(sequences.select(F.col("rep").alias("conv_id"), "weight", "n"), "conv_id")
        sums = running(stored(mine, "representatives"), ["conv_id"], ["pos"], {f"s{c}": c for c in LANES}, "prefix-keys")
        for c in LANES:
            sums = sums.withColumn(f"p{c}", F.col(f"s{c}") - F.col(c))
        up = _key([f"p{c}" for c in LANES])
        below = sums.select(F.col("conv_id").alias("rep"), (F.col("pos") + 1).alias("depth"), "chars", "weight", "n",
                            *_key([f"s{c}" for c in LANES]), up[0].alias("p1"), up[1].alias("p2"))
        root = sequences.select("rep", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("chars"), "weight", "n",
                                *[F.lit(0).cast("long").alias(c) for c in (*NODE, "p1", "p2")])
        prefixes = stored(below.unionByName(root), "prefixes")

        proper = prefixes.where("depth < n").select(*NODE).distinct()
        leaves = sequences.join(proper, NODE, "left_anti").select("rep", F.lit(1).alias("leaf"))
        nodes = stored(prefixes.join(leaves, "rep", "left").groupBy(*NODE).agg(
            F.min("depth").alias("depth"), F.min("rep").alias("conv_id"), F.sum("weight").alias("n_convs"), F.sum(F.coalesce("leaf", F.lit(0))).alias("n_leaves"),
            ((F.sum("weight") - 1) * F.max("chars")).alias("saved"), F.min("p1").alias("p1"), F.min("p2").alias("p2")), "nodes")

        shared = stored(nodes.where("n_convs > 1").select(*NODE, "conv_id", "depth", "saved", (-F.col("depth")).alias("rise")), "shared-nodes")
        paths = shared.groupBy(F.col("conv_id").alias("rep")).agg(F.sum("saved").alias("path"), F.min("depth").alias("top")).where("path > 0")
        lower = running(shared, ["conv_id"], ["rise"], {"own_path": "saved"}, "path-sums")
        above = prefixes.join(paths, "rep").where("depth < top").select(*NODE, F.col("path").alias("s"))
        # one aggregation by node for all that is added up there
        facts = ["depth", "conv_id", "p1", "p2", "n_convs", "n_leaves"]
        own = nodes.select(*NODE, *facts, F.lit(0).cast("long").alias("s"), F.lit(0).alias("child"))
        empty = [F.lit(None).cast("long").alias(c) for c in facts]
        more = above.unionByName(lower.select(*NODE, F.col("own_path").alias("s"))).select(*NODE, *empty, "s", F.lit(0).alias("child"))
        children = nodes.where("depth > 0").select(F.col("p1").alias("k1"), F.col("p2").alias("k2"), *empty, F.lit(0).cast("long").alias("s"), F.lit(1).alias("child"))
        whole = stored(own.unionByName(more).unionByName(children).groupBy(*NODE).agg(
            *[F.max(c).alias(c) for c in facts], F.sum("s").alias("saved_tokens"), F.sum("child").cast("long").alias("n_children")), "whole-nodes")
        parents = whole.where("n_children > 0").select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent"))
        out = stored(whole.join(parents, ["p1", "p2"], "left").select(
            *NODE, "depth", "conv_id", F.when(F.col("depth") > 0, F.col("parent")).alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens"), "trie")
        keep(out)
        keep(ends)
    return out, ends
