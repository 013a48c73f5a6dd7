"""MinHash near-dedup with ProbMinHash signatures of weighted word shingles.

A shingle is five lower-cased words (runs of non-space bytes); a shorter text
is one shingle of all its words. A shingle's weight is how often the text has
it. Two texts are near copies if their probability Jaccard similarity
(Moulton & Jiang 2018; with equal weights the usual Jaccard) is 0.8 or more.

1. Equal texts become one *node* (a 64-bit hash of the text).
2. *ProbMinHash* (Ertl 2020): each shingle makes a Poisson process of its
   weight's rate whose arrivals fall on random components; a component keeps
   the earliest arrival's shingle. A shingle stops as soon as its next arrival
   comes later than the latest component of its text.
3. *Banding*: ``BANDS`` keys of ``ROWS`` components. A pair at 0.8 shares no
   key with probability 0.0007, at 0.9 with 1e-8.
4. *Verification*: first each node against the least and the greatest node of
   each of its buckets, which is linear however large a bucket is. Buckets of
   one component need no more. Where several are left, a bucket of up to
   ``SPLIT`` nodes compares nodes of different components. In larger ones, the
   shingles that no other such text has bound what a text can share: texts that
   can't reach the threshold with any other go, the rest are compared with the
   bucket's centre, its text of the least share of own shingles. Two texts that
   still are in different components can only be near if they share enough
   shingles outside the centre, or if their parts of the centre suffice; just those pairs are compared. So no link of a bucket is lost, but neither
   texts that merely share a passage nor the copies of one text are all paired.
5. Connected components over the verified links are the classes.

Nulls and texts without words have no shingles: they are near no other text,
but equal texts are one class whatever they hold. Each row counts as a
document. A class's id is its least ``doc_id`` (null if it has none).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import textbytes as tb
from riskloom.llm.components import components
from riskloom.llm.packed import BLOB, ID, KEY, TEXT_KEY, keys, packed, text_of, unpack
from riskloom.llm.shared import scratch, stored

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 24, 6
SPLIT = 8
SIZES = ("node", "label", "s", "extra", "over", "under")
SMALL = 64  # texts with fewer shingles are signed together, batch by batch
HELD = 1 << 18  # shingles of small texts signed at once


def shingles(data: np.ndarray, offsets: np.ndarray, n: int = SHINGLE):
    """Distinct weighted shingles of a chunk: text index, hash, weight; sorted by text and hash."""
    _, _, hashes, first = tb.words(data, offsets, tb.word_table())
    grams, whole = tb.ngrams(hashes, first, n)
    count = np.diff(first)
    doc = np.repeat(np.arange(len(count)), count)
    doc, grams = doc[whole], grams[whole]
    for i in np.flatnonzero((count > 0) & (count < n)):  # one shingle of all words
        acc = np.uint64(count[i])
        with np.errstate(over="ignore"):
            for h in hashes[first[i]: first[i + 1]]:
                acc = acc * tb.MULT + h
        doc, grams = np.append(doc, i), np.append(grams, tb.mix(np.array([acc])))
    order = np.lexsort((grams, doc))
    doc, grams = doc[order], grams[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (grams[1:] != grams[:-1])
    at = np.flatnonzero(new)
    return doc[at], grams[at], np.diff(np.append(at, len(doc))).astype(np.float64)


def probminhash(doc: np.ndarray, elem: np.ndarray, weight: np.ndarray, texts: int, m: int) -> np.ndarray:
    """Signatures ``[texts, m]`` of weighted sets given as parallel arrays; every text needs an element."""
    arrival = np.full(texts * m, np.inf)
    winner = np.zeros(texts * m, np.uint64)
    limit = np.full(texts, np.inf)  # the latest component of each text
    time, seed, turn = np.zeros(len(doc)), elem, 0
    while len(doc):
        turn += 1
        draw = tb.mix(seed + np.uint64(turn * int(tb.MULT) & 0xFFFFFFFFFFFFFFFF))
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / weight
        live = time < limit[doc]
        if not live.all():
            doc, seed, weight, time, draw = doc[live], seed[live], weight[live], time[live], draw[live]
        # an independent second draw picks the component
        slot = doc * m + (tb.mix(draw ^ tb.MIX2) % np.uint64(m)).astype(np.int64)
        np.minimum.at(arrival, slot, time)
        best = arrival[slot] == time
        winner[slot[best]] = seed[best]
        limit = arrival.reshape(texts, m).max(axis=1)
    return winner.reshape(texts, m)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = signatures.reshape(len(signatures), bands, rows)
    acc = np.zeros(parts.shape[:2], np.uint64) + np.arange(1, bands + 1, dtype=np.uint64) * tb.MIX1
    for j in range(rows):
        acc = tb.mix(acc * tb.MULT + parts[:, :, j])
    return acc.view(np.int64)


def _signed(doc, elem, weight, nodes, bands, rows):
    present, compact = np.unique(doc, return_inverse=True)
    sig = probminhash(compact, elem, weight, len(present), bands * rows)
    keyed = band_keys(sig, bands, rows)
    lists = pa.ListArray.from_arrays(np.arange(0, keyed.size + 1, bands, dtype=np.int32), pa.array(keyed.ravel()))
    return pa.RecordBatch.from_arrays([pa.array(nodes[present]), lists], names=["node", "bands"])


def _band_rows(bands: int, rows: int):
    def run(batches):
        tb.lean()
        for b in batches:
            nodes = b.column(0).to_numpy(zero_copy_only=False)
            small, held = [], 0
            for r0, _, data, offsets in tb.chunks(b.column(1)):
                doc, elem, weight = shingles(data, offsets)
                if not len(doc):
                    continue
                few = np.bincount(doc)[doc] < SMALL
                if few.any():
                    small.append((doc[few] + r0, elem[few], weight[few]))
                    held += len(small[-1][0])
                if not few.all():
                    yield _signed(doc[~few] + r0, elem[~few], weight[~few], nodes, bands, rows)
                if held >= HELD:
                    yield _signed(*map(np.concatenate, zip(*small, strict=True)), nodes, bands, rows)
                    small, held = [], 0
            if small:
                yield _signed(*map(np.concatenate, zip(*small, strict=True)), nodes, bands, rows)
    return run


def similarity(ea: np.ndarray, wa: np.ndarray, eb: np.ndarray, wb: np.ndarray) -> float:
    """Probability Jaccard similarity of two weighted sets with sorted distinct elements."""
    if not len(ea) or not len(eb):
        return 0.0
    _, ia, ib = np.intersect1d(ea, eb, assume_unique=True, return_indices=True)
    if not len(ia):
        return 0.0
    ca, cb = wa[ia], wb[ib]
    alone_a, alone_b = wa.sum() - ca.sum(), wb.sum() - cb.sum()
    ratio, at = np.unique(ca / cb, return_inverse=True)
    out = 0.0
    for k, r in enumerate(ratio):  # few distinct ratios: weights are counts
        scale = np.maximum(ca, cb * r).sum() + alone_a + alone_b * r
        out += (ca[at == k] / scale).sum()
    return float(out)


def _weighted(blobs: list[bytes]):
    """Weighted shingle sets of some texts."""
    out = []
    texts = pa.array([unpack(x) for x in blobs], pa.binary())
    for r0, r1, data, offsets in tb.chunks(texts):
        doc, elem, weight = shingles(data, offsets)
        edge = np.searchsorted(doc, np.arange(r1 - r0 + 1))
        out += [(elem[x:y], weight[x:y]) for x, y in zip(edge[:-1], edge[1:], strict=True)]
    return out


def _verified(threshold: float):
    def run(batches):
        tb.lean()
        for b in (y for whole in batches for x in tb.slices(whole, 2, 1 << 18) for y in tb.slices(x, 3, 1 << 18)):
            firsts, seconds = b.column(0).to_pylist(), b.column(1).to_pylist()
            own: dict[int, int] = {}
            blobs = []
            for node, blob in zip(firsts, b.column(2), strict=True):
                if node not in own:
                    own[node] = len(blobs)
                    blobs.append(blob.as_py())
            sets = _weighted(blobs)
            others = _weighted(b.column(3).to_pylist())
            near = [similarity(*sets[own[x]], *y) >= threshold - 1e-12 for x, y in zip(firsts, others, strict=True)]
            keep = pa.array(near, pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(firsts, pa.int64()), pa.array(seconds, pa.int64())], names=["a", "b"]).filter(keep)
    return run


def _node_texts(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The compressed texts of the nodes of some pairs."""
    slim = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    need = pairs.select(F.col("a").alias(TEXT_KEY)).unionByName(pairs.select(F.col("b").alias(TEXT_KEY))).distinct()
    owner = slim.select(*keys(id_col, text_col)).join(need, TEXT_KEY).groupBy(TEXT_KEY).agg(F.min(ID).alias(ID))
    rows = packed(slim, id_col, text_col).join(owner, KEY)
    return stored(rows.select(F.col(TEXT_KEY).alias("node"), BLOB), "texts")


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``(a, b)`` of nodes whose texts are near copies."""
    left = texts.select(F.col("node").alias("a"), F.col(BLOB).alias("za"))
    right = texts.select(F.col("node").alias("b"), F.col(BLOB).alias("zb"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "za", "zb")
    return stored(both.mapInArrow(_verified(threshold), "a long, b long"), "links")


def _shingle_rows(batches):
    tb.lean()
    for b in (x for whole in batches for x in tb.slices(whole, 1, 1 << 18)):
        for node, (elem, weight) in zip(b.column(0).to_pylist(), _weighted(b.column(1).to_pylist()), strict=True):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(elem), node), pa.int64()), pa.array(elem.view(np.int64)), pa.array(weight)], names=["node", "elem", "w"])


def own_share(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """For each node its weight ``s``, its ``extra`` weight beyond one for each shingle, and ``u``, the weight that no other node has."""
    rows = stored(texts.join(nodes, "node").select("node", BLOB).mapInArrow(_shingle_rows, "node long, elem long, w double"), "shingles")
    alone = (rows.groupBy("elem").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node"), F.min("w").alias("w")).where("n = 1")
             .groupBy("node").agg(F.sum("w").alias("u")))
    sizes = rows.groupBy("node").agg(F.sum("w").alias("s"), (F.sum("w") - F.count(F.lit(1))).alias("extra"))
    return sizes.join(alone, "node", "left").fillna(0.0, ["u"])


def _against_centre(batches):
    """Rows (node, centre, both texts) to what a text shares with its centre, and its shingles outside.

    ``over`` is how much a text's counts exceed the centre's, and one for each
    shingle outside; ``under`` how much the centre's counts exceed the text's.
    """
    tb.lean()
    for b in (y for whole in batches for x in tb.slices(whole, 2, 1 << 18) for y in tb.slices(x, 3, 1 << 18)):
        centres: dict[int, int] = {}
        blobs = []
        for node, blob in zip(b.column(1).to_pylist(), b.column(3), strict=True):
            if node not in centres:
                centres[node] = len(blobs)
                blobs.append(blob.as_py())
        theirs, inside, over, under, outside = _weighted(blobs), [], [], [], []
        for centre, (elem, weight) in zip(b.column(1).to_pylist(), _weighted(b.column(2).to_pylist()), strict=True):
            base, counts = theirs[centres[centre]]
            shared = np.isin(elem, base, assume_unique=True)
            beyond = weight[shared] - counts[np.searchsorted(base, elem[shared])]
            inside.append(weight[shared].sum())
            over.append(np.maximum(beyond, 0).sum() + (weight[~shared] - 1).sum())
            under.append(np.maximum(-beyond, 0).sum())
            outside.append(pa.StructArray.from_arrays([pa.array(elem[~shared].view(np.int64)), pa.array(weight[~shared])], names=["elem", "w"]))
        edges = np.concatenate([[0], np.cumsum([len(x) for x in outside])]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), *(pa.array(x, pa.float64()) for x in (inside, over, under)),
             pa.ListArray.from_arrays(edges, pa.concat_arrays(outside))],
            names=["node", "centre", "inside", "over", "under", "outside"])


def _chief_centres(large: DataFrame, centres: DataFrame) -> DataFrame:
    """Members of buckets with one centre for all buckets whose centres are in one component.

    Any text may serve as a centre; a node thus meets one for each component
    instead of one for each bucket. The centre of the most members is taken.
    """
    here = large.join(centres.select("key", F.col("r.node").alias("centre")), "key")
    own = here.where("node = centre").select("centre", "label").distinct()
    chief = (here.groupBy("centre").agg(F.count(F.lit(1)).alias("n")).join(own, "centre")
             .groupBy("label").agg(F.max_by("centre", F.struct("n", "centre")).alias("chief")))
    place = own.join(chief, "label").select("centre", "chief")
    return here.join(place, "centre").select("node", "label", "s", "extra", F.col("chief").alias("centre")).distinct()


def _bound(shared, s, s_other, excess, alone_other=None):
    """Upper bound of the similarity of two texts of which one, of weight ``s``, shares at most ``shared``.

    With x's shared weight S, y's weight alone A, and E the sum of what y's
    counts exceed x's on shared shingles, similarity is at most
    ``(S + min(E, S) * A / s) / (s + A)``. E is at most ``excess``, and A at
    least ``s_y - S - excess``, or what is given for it. The bound grows with
    ``shared`` and ``excess``, and falls with the other's weight and what it has
    alone.
    """
    alone = F.greatest(s_other - shared - excess, F.lit(0.0) if alone_other is None else alone_other, F.lit(0.0))
    return (shared + F.least(excess, shared) * alone / s) / (s + alone)


def _excess(under, over_other, extra_other):
    """Upper bound of what the other's counts exceed a text's on shared shingles.

    Counts are whole, so it is at most the other's extra weight; and at most what
    the other's counts exceed the centre's and the centre's the text's.
    """
    return F.least(extra_other, over_other + under)


def _reaches(left: str, right: str, shared: str, threshold: float):
    """Whether a pair may be near of which each shares at most its column ``shared``."""
    x, y = (lambda c: F.col(f"{left}.{c}")), (lambda c: F.col(f"{right}.{c}"))
    return _bound(x(shared), x("s"), y("s"), _excess(x("under"), y("over"), y("extra")), y("s") - y(shared)) >= threshold - 1e-9


def _sharing_outside(near: DataFrame, threshold: float) -> DataFrame:
    """Pairs of different components that share enough outside their centre.

    Of the shingles outside the centre that another component has too, each text
    takes the rarest first. A pair's first common one, at which both still have
    ``most`` to share, must leave room for a similarity of ``threshold``.
    """
    # exploding makes many rows of one: dealt out evenly first, since a hot centre's texts lie together
    even = near.repartition(int(near.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    members = even.select("centre", F.explode("outside").alias("o"), *SIZES, "inside").select("*", "o.*").drop("o")
    held = (members.groupBy("centre", "elem").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("x"), F.max("label").alias("y"))
            .where("x <> y").select("centre", "elem", "n"))
    rest = Window.partitionBy("centre", "node").orderBy("n", "elem").rowsBetween(0, Window.unboundedFollowing)
    most = F.col("inside") + F.sum("w").over(rest)
    ranked = stored(members.join(held, ["centre", "elem"]).select("centre", "elem", *SIZES, most.alias("most")), "outside")
    widest = near.groupBy("centre").agg(F.max("extra").alias("widest"), F.max("over").alias("most_over"))
    least = ranked.join(widest, "centre").where(
        _bound(F.col("most"), F.col("s"), F.col("s"), _excess(F.col("under"), F.col("most_over"), F.col("widest"))) >= threshold - 1e-9)
    on = ((F.col("l.centre") == F.col("r.centre")) & (F.col("l.elem") == F.col("r.elem")) & (F.col("l.label") != F.col("r.label"))
          & ((F.col("l.s") < F.col("r.s")) | ((F.col("l.s") == F.col("r.s")) & (F.col("l.node") < F.col("r.node"))))
          & _reaches("l", "r", "most", threshold) & _reaches("r", "l", "most", threshold))
    return (least.alias("l").join(ranked.alias("r"), on)
            .select(F.least("l.node", "r.node").alias("a"), F.greatest("l.node", "r.node").alias("b")))


def around_centres(large: DataFrame, centres: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Pairs of different components of large buckets that may be near although one isn't near the centre.

    Such a pair shares shingles outside centre c, or at most what each of the two
    has in c, and each has the rest alone.
    """
    near = stored(_chief_centres(large, centres), "near")
    both = (near.select("node", "centre").join(texts, "node").withColumnRenamed(BLOB, "zx")
            .join(texts.select(F.col("node").alias("centre"), F.col(BLOB).alias("zc")), "centre").select("node", "centre", "zx", "zc"))
    parts = both.mapInArrow(_against_centre, "node long, centre long, inside double, over double, under double, outside array<struct<elem:long,w:double>>")
    near = stored(near.join(parts, ["node", "centre"]), "around")
    shared = _sharing_outside(near, threshold)
    sized = near.select(*SIZES, "centre", "inside")
    group = sized.groupBy("centre").agg(F.min("s").alias("least"), F.max("extra").alias("widest"), F.max("over").alias("most_over"),
                                        F.max(F.when(F.col("node") == F.col("centre"), F.col("label"))).alias("own"))
    apart = sized.join(group, "centre").where(
        (F.col("label") != F.col("own")) & (_bound(F.col("inside"), F.col("s"), F.col("least"), _excess(F.col("under"), F.col("most_over"), F.col("widest"))) >= threshold - 1e-9))
    fits = ((F.col("l.centre") == F.col("r.centre")) & (F.col("l.label") != F.col("r.label"))
            & _reaches("l", "r", "inside", threshold) & _reaches("r", "l", "inside", threshold))
    by_size = apart.alias("l").join(sized.alias("r"), fits).select(F.least("l.node", "r.node").alias("a"), F.greatest("l.node", "r.node").alias("b"))
    return shared.unionByName(by_size).distinct()


def _mixed(members: DataFrame) -> DataFrame:
    """Rows of buckets that hold several components, with the bucket's ``size``."""
    spread = (members.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count(F.lit(1)).alias("size"))
              .where("x <> y").select("key", "size"))
    return members.join(spread, "key")


def _across(members: DataFrame) -> DataFrame:
    """Pairs of nodes of different components in a bucket."""
    on = (F.col("l.key") == F.col("r.key")) & (F.col("l.label") < F.col("r.label"))
    joined = members.alias("l").join(members.alias("r"), on)
    return joined.select(F.least("l.node", "r.node").alias("a"), F.greatest("l.node", "r.node").alias("b")).distinct()


def _relabelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    rest = [c for c in rows.columns if c != "label"]
    return rows.select(*rest).join(labels, "node", "left").select(*rest, F.coalesce("label", "node").alias("label"))


def near_nodes(signed: DataFrame, docs: DataFrame, id_col: str, text_col: str, threshold: float, split: int) -> DataFrame:
    """``(node, label)`` for nodes that have a near copy, from ``(node, bands)``."""
    members = signed.select("node", F.explode("bands").alias("key"))
    heads = stored(members.groupBy("key").agg(F.min("node").alias("x"), F.max("node").alias("y")).where("x <> y"), "heads")
    done = stored(members.join(heads, "key").select("node", F.explode(F.array("x", "y")).alias("head")).where("node <> head")
                  .select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct(), "pairs")
    texts = _node_texts(done, docs, id_col, text_col)
    labels = stored(components(verified(done, texts, threshold)), "labels")

    def linked(labels: DataFrame, pairs: DataFrame) -> DataFrame:
        more = verified(pairs, texts, threshold)
        if more.isEmpty():
            return labels
        return stored(components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(more)), "labels")

    mixed = stored(_mixed(_relabelled(members.join(heads.select("key"), "key"), labels)), "mixed")
    large = mixed.where(F.col("size") > split)
    shares = own_share(large.select("node").distinct(), texts).where(F.col("s") - F.col("u") >= (threshold - 1e-9) * F.col("s"))
    large = stored(large.select("key", "node", "label").join(shares, "node"), "large")
    centre = stored(large.groupBy("key").agg(F.min_by(F.struct("node", "label", "s", "u", "extra"), F.struct(F.col("u") / F.col("s"), F.col("node"))).alias("r")), "centres")
    to_centre = (large.select("key", F.struct("node", "label", "s", "u", "extra").alias("l")).join(centre, "key")
                 .where(F.col("l.label") != F.col("r.label"))
                 .select(F.least("l.node", "r.node").alias("a"), F.greatest("l.node", "r.node").alias("b")))
    pairs = stored(_across(mixed.where(F.col("size") <= split)).unionByName(to_centre).distinct().join(done, ["a", "b"], "left_anti"), "pairs")
    labels = linked(labels, pairs)
    done = done.unionByName(pairs)
    left = stored(_mixed(_relabelled(large, labels)), "mixed")
    if left.isEmpty():
        return labels
    rest = around_centres(left, centre, texts, threshold).join(done, ["a", "b"], "left_anti")
    return linked(labels, stored(rest, "pairs"))


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                 bands: int = BANDS, rows: int = ROWS, split: int = SPLIT) -> DataFrame:
    """``(__id, __tk, class_id, class_size, keep)`` for each row of ``docs``.

    ``keep`` marks a class's least id (null last), of several texts with that id
    the one of the least hash; repeated rows of that text are all marked.
    """
    nodes = docs.select(F.xxhash64(text_of(text_col)).alias("node"), text_of(text_col).alias("text"))
    with scratch(docs.sparkSession) as keep:
        signed = stored(nodes.mapInArrow(_band_rows(bands, rows), "node long, bands array<long>")
                        .groupBy("node").agg(F.first("bands").alias("bands")), "bands")
        labels = near_nodes(signed, docs, id_col, text_col, threshold, split)
        rows_of = docs.select(*keys(id_col, text_col), F.col(f"`{id_col}`").cast("long").alias("__own"))
        placed = rows_of.join(labels, rows_of[TEXT_KEY] == labels["node"], "left").select(*KEY, "__own", F.coalesce("label", TEXT_KEY).alias("__label"))
        least = F.min(F.struct(F.isnull("__own").alias("none"), F.col("__own").alias("id"), F.col(TEXT_KEY).alias("text")))
        classes = stored(placed.groupBy("__label").agg(least.alias("r"), F.count(F.lit(1)).alias("class_size"))
                         .select("__label", F.col("r.id").alias("class_id"), F.col("r.text").alias("__first"), "class_size"), "classes")
        keep(labels)
        keep(classes)
    return (placed.join(classes, "__label")
            .select(*KEY, F.col("__own").alias(id_col), "class_id", "class_size", (F.col("__own").eqNullSafe(F.col("class_id")) & (F.col(TEXT_KEY) == F.col("__first"))).alias("keep")))
