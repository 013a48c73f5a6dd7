"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

1. Words are lower-cased runs of ASCII letters, digits and multi-byte
   characters; each character of a script without spaces is a word. All
   ``seed``-grams of the test items are seeds, however common: those that survive
   in a widely copied edited version of an item are just the ones that are found
   most often. A shorter item has one seed, all its words.
2. Passages of a document that hold a seed are joined to the seed's items, and
   item and passage are aligned by words: ``MATCH`` for equal words,
   ``MISMATCH`` and ``GAP`` for edits. The score is the best local alignment
   over the item's number of words; 1 is a full copy.
3. A document is contaminated if an item reaches ``threshold`` with at least
   ``LEAST`` net words (or all words of a shorter item).

Documents are never shuffled: items are few beside the corpus and go to the
tasks. Their bytes are counted first; beyond ``block_bytes`` they are dealt into
blocks by hash, and the documents pass through each block's search. A phrase
that many items and documents share costs an alignment for each pair; what is
held at once stays at about ``JOINED`` pairs of places.

Null and empty texts hold no seed. An item of fewer words than a seed is found
where all its words stand in order, be it one word. A null item or one without
words can't be found. Repeated items count once each; of equal scores
the least item id is named. Each row of documents gets its own result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import textbytes as tb

SEED, THRESHOLD, LEAST = 4, 0.4, 8
MATCH, MISMATCH, GAP = 1.0, -0.5, -0.5
BLOCK_BYTES = 8 << 20
CELLS = 1 << 20  # of an alignment table that is filled at once
JOINED = 1 << 17  # places in documents joined to places in items at once


def _table() -> np.ndarray:
    return tb.word_table(letters=True, digits=True)


def _words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
    """Word hashes, and each text's first word index."""
    return tb.words(data, offsets, table, tb.unspaced(data))[2:]


class Items:
    """Test items of one block: word hashes, and which item has a seed where."""

    def __init__(self, ids: list, texts: list[str], seed: int):
        self.seed = seed
        self.ids, self.words, grams, owner, place = [], [], [], [], []
        for item, text in zip(ids, texts, strict=True):
            data = np.frombuffer((text or "").encode(), np.uint8)
            hashes, first = _words(data, np.array([0, len(data)]), _table())
            if not len(hashes):
                continue
            found, whole = tb.ngrams(hashes, first, min(seed, len(hashes)))
            k = len(self.ids)
            self.ids.append(item)
            self.words.append(hashes)
            grams.append(found[whole])
            owner.append(np.full(whole.sum(), k))
            place.append(np.flatnonzero(whole))
        self.order(np.concatenate([np.zeros(0, np.uint64), *grams]), np.concatenate([np.zeros(0, np.int64), *owner]),
                   np.concatenate([np.zeros(0, np.int64), *place]))
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.lengths = np.unique(np.minimum(self.sizes, seed)).tolist()  # of seeds

    def order(self, grams, owner, place):
        by = np.argsort(grams, kind="stable")
        self.grams, self.owner, self.place = grams[by], owner[by], place[by]
        self.keys, self.first = np.unique(self.grams, return_index=True)
        self.count = np.diff(np.append(self.first, len(self.grams)))
        self.posted = np.repeat(np.arange(len(self.keys)), self.count) * len(self.ids) + self.owner
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[self.keys >> np.uint64(44)] = True

    def hits(self, hashes: np.ndarray, first: np.ndarray):
        """Places of words that begin a seed, in order, and the index of the seed's key."""
        places, keys = [], []
        for n in self.lengths:
            grams, whole = tb.ngrams(hashes, first, n)
            at = np.flatnonzero(self.sieve[(grams >> np.uint64(44)).astype(np.int64)] & whole)
            key = np.searchsorted(self.keys, grams[at])
            ok = key < len(self.keys)
            ok[ok] = self.keys[key[ok]] == grams[at[ok]]
            places.append(at[ok])
            keys.append(key[ok])
        at, key = np.concatenate(places), np.concatenate(keys)
        by = np.argsort(at, kind="stable")
        return at[by], key[by]


def align(items: list[np.ndarray], passages: list[np.ndarray]) -> np.ndarray:
    """Best local alignment score of each item with its passage."""
    best = np.zeros(len(items), np.float32)
    sizes = np.array([[len(a), len(b)] for a, b in zip(items, passages, strict=True)])
    order = np.lexsort((sizes[:, 0], sizes[:, 1]))
    a = 0
    while a < len(order):
        b = a + 1
        while b < len(order) and (b + 1 - a) * sizes[order[b], 1] <= CELLS // 64:
            b += 1
        rows = order[a:b]
        high, wide = sizes[rows, 0].max(), sizes[rows, 1].max()
        left = np.zeros((len(rows), high), np.uint64)  # padding 0 and 1 never agree
        right = np.ones((len(rows), wide), np.uint64)
        for r, k in enumerate(rows):
            left[r, : len(items[k])] = items[k] | np.uint64(2)
            right[r, : len(passages[k])] = passages[k] | np.uint64(2)
        ramp = (np.arange(wide + 1) * -GAP).astype(np.float32)
        above = np.zeros((len(rows), wide + 1), np.float32)
        for i in range(high):
            cell = np.zeros_like(above)
            step = np.where(left[:, i: i + 1] == right, np.float32(MATCH), np.float32(MISMATCH))
            np.maximum(above[:, :-1] + step, above[:, 1:] + np.float32(GAP), out=cell[:, 1:])
            np.maximum(cell, 0, out=cell)
            above = np.maximum.accumulate(cell + ramp, axis=1) - ramp  # gaps in the item
            best[rows] = np.maximum(best[rows], above.max(axis=1))
        a = b
    return best


def _passages(items: Items, at, key, doc, first, low: int, high: int):
    """Joined seeds to (text, item, first word, last word + 1), one for each stretch of seeds on near diagonals.

    Of items from ``low`` on, below ``high``.
    """
    post, stop = (np.searchsorted(items.posted, key * len(items.ids) + k) for k in (low, high))
    n = stop - post
    post = np.arange(n.sum()) + np.repeat(post - (np.cumsum(n) - n), n)
    at, doc = np.repeat(at, n), np.repeat(doc, n)
    item = items.owner[post]
    size = items.sizes[item]
    start = at - items.place[post]
    by = np.lexsort((start, item, doc))
    doc, item, start, size = doc[by], item[by], start[by], size[by]
    slack = size // 4 + 2
    a, b = np.maximum(start - slack, first[doc]), np.minimum(start + size + slack, first[doc + 1])
    new = np.ones(len(a), bool)  # of one text and item, both ends grow along the rows
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (a[1:] > b[:-1])
    last = np.ones(len(a), bool)
    last[:-1] = new[1:]
    return list(zip(doc[new].tolist(), item[new].tolist(), a[new].tolist(), b[last].tolist(), strict=True))


def _found(items: Items, at, key, doc, first, joined: int):
    """Lists of passages, none empty. All of a text and item are in one list."""
    total = np.cumsum(items.count[key])
    edge = np.append(np.flatnonzero(np.diff(doc, prepend=-1)), len(doc))  # each text's first hit
    k = 0
    while k < len(edge) - 1:
        a = edge[k]
        before = total[a - 1] if a else 0
        k = max(k + 1, int(np.searchsorted(total[edge[1:] - 1], before + joined, "right")))
        b = edge[k]
        parts = min(len(items.ids), math.ceil((total[b - 1] - before) / joined))  # of items, for a text of more hits
        cuts = [len(items.ids) * p // parts for p in range(parts + 1)]
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            if found := _passages(items, at[a:b], key[a:b], doc[a:b], first, low, high):
                yield found


def _scores(items: Items, column: int, threshold: float, n_cols: int, names: list[str], joined: int):
    """Rows of documents with (n_items, best_item, best_score) so far, to the same after this block."""
    def run(batches):
        tb.lean()
        table, sizes = _table(), items.sizes
        for b in batches:
            count = b.column(n_cols).to_numpy(zero_copy_only=False).copy()
            best = b.column(n_cols + 1).to_pylist()
            score = b.column(n_cols + 2).to_numpy(zero_copy_only=False).copy()
            for r0, _, data, offsets in tb.chunks(b.column(column)):
                hashes, first = _words(data, offsets, table)
                at, key = items.hits(hashes, first)
                if not len(at):
                    continue
                doc = np.searchsorted(first, at, "right") - 1
                for found in _found(items, at, key, doc, first, joined):
                    raw = align([items.words[i] for _, i, _, _ in found], [hashes[x:y] for _, _, x, y in found])
                    top: dict[tuple[int, int], float] = {}
                    for (d, i, _, _), s in zip(found, raw.tolist(), strict=True):
                        top[d, i] = max(top.get((d, i), 0.0), s)
                    for (d, i), s in top.items():
                        r, part = r0 + d, s / sizes[i]
                        if part > score[r] or (part == score[r] and best[r] is not None and items.ids[i] is not None and items.ids[i] < best[r]):
                            score[r], best[r] = part, items.ids[i]
                        count[r] += part >= threshold and s >= min(LEAST, sizes[i])
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:n_cols], pa.array(count, pa.int64()), pa.array(best, pa.int64()), pa.array(score, pa.float64())], names=names)
    return run


def scored(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
           seed: int = SEED, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES, joined: int = JOINED) -> DataFrame:
    """``docs`` with ``n_items`` (items found), ``best_item`` and ``best_score``; ``n_items > 0`` means contaminated.

    These replace input columns of the same names.
    """
    cols = [c for c in docs.columns if c not in ("n_items", "best_item", "best_score")]
    out = docs.select(*[F.col(f"`{c}`") for c in cols], F.lit(0).cast("long").alias("n_items"),
                      F.lit(None).cast("long").alias("best_item"), F.lit(0.0).alias("best_score"))
    names, at = out.columns, cols.index(text_col)
    plain = items.select(F.col(f"`{item_col}`").cast("long").alias("item"), F.col(f"`{item_text}`").cast("string").alias("text")).where("text is not null")
    size = plain.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(size / block_bytes))
    for k in range(blocks):
        part = plain.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k).orderBy("item", "text").collect()
        block = Items([r.item for r in part], [r.text for r in part], seed)
        if block.ids:
            out = out.mapInArrow(_scores(block, at, threshold, len(cols), names, joined), out.schema)
    return out
