"""Cross-tokenizer alignment: which tokens of two tokenizers share bytes, and which id pairs go together.

Both tokenizers encode space + text (the second adds the space itself). A
block's tokens lie end to end as two frames (document, start, end, id).
``pandas.merge_asof``, by document, gives each token the other side's token that
covers its start; both directions together are all overlaps. Where two
overlapping tokens end at the same byte, a group ends. All pairs of a group's
tokens are links.

How many documents hold an id pair linked is counted in Spark: every block of
about ``BLOCK`` bytes of text lists its distinct pairs once, with their documents, so the
shuffle carries pairs of blocks, not of documents. Counts go back to the blocks by
the same pairs, and a task has one block with its counts at a time. The highest count of an id has at most as many rows as the
first vocabulary.

A text that is null or empty, or that either tokenizer doesn't give back byte
for byte, has no tokens: zeros, and ``''`` for the groups. Special tokens'
strings inside texts are plain text. Repeated rows are documents of their own; a
null id stays null; an empty table gives no rows. Other columns are left alone.
A text longer than a block is a block of its own.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import textbytes as tb
from riskloom.llm.segments import ByteLevel, Kept, Pieces, for_worker, forget
from riskloom.llm.shared import scratch, stored

MODEL_A, MODEL_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
CHUNK = 1 << 19  # bytes aligned at once
BLOCK = 1 << 21
FILE_BLOCKS = 8  # blocks stored in one file
SEGMENTS = 250_000  # kept of each vocabulary; as fast as 500,000, of which both would take some 250 MB of a worker
WIDE = 1 << 22  # links listed at once


def frame(ids: np.ndarray, first: np.ndarray, size: np.ndarray) -> pd.DataFrame:
    """Tokens of texts laid end to end: document, first byte, end, id."""
    end = np.cumsum(size[ids])
    return pd.DataFrame({"doc": np.repeat(np.arange(len(first) - 1), np.diff(first)), "start": end - size[ids], "end": end, "id": ids})


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """Places of all pairs of overlapping tokens, in order, and whether both end at the same byte."""
    left, right = a[["doc", "start"]], b[["doc", "start"]]
    a_in_b = pd.merge_asof(left, right.assign(b=np.arange(len(b))), on="start", by="doc")["b"].to_numpy(np.int64)
    b_in_a = pd.merge_asof(right, left.assign(a=np.arange(len(a))), on="start", by="doc")["a"].to_numpy(np.int64)
    # both lists ascend in a and in b: the order of a pair is its place in the other side's order, and a stable sort merges them
    key = np.sort(np.concatenate([np.arange(len(a)) * np.int64(len(b)) + a_in_b, b_in_a * np.int64(len(b)) + np.arange(len(b))]), kind="stable")
    key = key[np.flatnonzero(np.r_[True, key[1:] != key[:-1]])] if len(key) else key
    at_a, at_b = key // len(b), key % len(b)
    return pd.DataFrame({"a": at_a, "b": at_b, "ends": a["end"].to_numpy()[at_a] == b["end"].to_numpy()[at_b]})


def groups(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of both frames, numbered on through all documents."""
    met = overlaps(a, b)
    ends = met["ends"].to_numpy()
    number = np.cumsum(ends) - ends
    of_a, of_b = np.empty(len(a), np.int64), np.empty(len(b), np.int64)
    of_a[met["a"].to_numpy()] = number
    of_b[met["b"].to_numpy()] = number
    return of_a, of_b


def said(a_ids, a_group, b_ids, b_group) -> tuple[np.ndarray, np.ndarray]:
    """Groups as text, ``a1,a2|b1;a3|b2,b3``, and the first byte of each group in it with the end.

    Every group's text ends with ``;``, which is left out after a document's last.
    """
    n_groups = int(a_group[-1]) + 1
    in_a, in_b = np.bincount(a_group, minlength=n_groups), np.bincount(b_group, minlength=n_groups)
    before_a, before_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
    n = len(a_ids) + len(b_ids)
    ids, mark = np.empty(n, np.int32), np.full(n, ord(","), np.uint8)
    ids[np.arange(len(a_ids)) + before_b[a_group]] = a_ids
    ids[np.arange(len(b_ids)) + (before_a + in_a)[b_group]] = b_ids
    last = before_a + before_b + in_a
    mark[last - 1] = ord("|")
    mark[last + in_b - 1] = ord(";")
    digits, tens = np.ones(n, np.int64), 10
    while tens <= ids.max(initial=0):
        digits += ids >= tens
        tens *= 10
    stop = np.cumsum(digits + 1)
    out = np.empty(int(stop[-1]) if n else 0, np.uint8)
    out[stop - 1] = mark
    left = ids.copy()
    for k in range(int(digits.max(initial=0))):
        here = digits > k
        out[stop[here] - 2 - k] = 48 + left[here] % 10
        left //= 10
    ends = stop[last + in_b - 1]
    return out, np.concatenate([[0], ends])


def links(doc, a_ids, a_group, b_ids, b_group):
    """Yield (document, a * 2**32 + b, how often) of linked id pairs, in parts of about ``WIDE`` rows.

    ``doc`` is each group's document. Equal ids of one group count together first.
    """
    def distinct(ids, group):
        key, n = np.unique(group << 32 | ids, return_counts=True)
        return key >> 32, key & 0xFFFFFFFF, n

    ga, a, na = distinct(a_ids, a_group)
    gb, b, nb = distinct(b_ids, b_group)
    first_b = np.searchsorted(gb, np.arange(len(doc) + 1))
    each = np.diff(first_b)[ga]
    total = np.concatenate([[0], np.cumsum(each)])
    x = 0
    while x < len(ga):
        y = max(x + 1, int(np.searchsorted(total, total[x] + WIDE, "right")) - 1)
        rows = np.repeat(np.arange(x, y), each[x:y])
        at = np.arange(total[y] - total[x]) - np.repeat(total[x:y] - total[x], each[x:y]) + first_b[ga[rows]]
        yield doc[ga[rows]], a[rows] << 32 | b[at], na[rows] * nb[at]
        x = y


def _summed(doc, pair, n):
    short = (pair >> 32 << 16) | (pair & 0xFFFF)  # one key sorts faster, where ids are short
    fits = len(doc) and doc[-1] < 1 << 31 and pair.max() < 1 << 48 and (pair & 0xFFFFFFFF).max() < 1 << 16 and doc.max() == doc[-1]
    by = np.argsort(doc << 32 | short) if fits else np.lexsort((pair, doc))
    doc, pair, n = doc[by], pair[by], n[by]
    new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])]) if len(doc) else np.zeros(0, np.int64)
    return doc[new], pair[new], np.add.reduceat(n, new) if len(new) else n


def align(data: np.ndarray, offsets: np.ndarray, kept_a: Kept, kept_b: Kept):
    """Texts (with the space before each) to counts of each, hashes of its groups, and its linked pairs.

    A text is its space alone if it has no tokens.
    """
    n = len(offsets) - 1
    size = np.diff(offsets)
    counts, hashes = np.zeros((n, 4), np.int64), [""] * n
    ids_a, first_a, back_a = kept_a.encode(data, offsets)
    ids_b, first_b, back_b = kept_b.encode(data, offsets)
    good = (size > 1) & back_a & back_b
    none = np.zeros(0, np.int64)
    if not good.any():
        return counts, hashes, (none, none, none)
    n_a, n_b = np.diff(first_a) * good, np.diff(first_b) * good
    ids_a, ids_b = ids_a[np.repeat(good, np.diff(first_a))], ids_b[np.repeat(good, np.diff(first_b))]
    a = frame(ids_a, np.concatenate([[0], np.cumsum(n_a)]), kept_a.size)
    b = frame(ids_b, np.concatenate([[0], np.cumsum(n_b)]), kept_b.size)
    of_a, of_b = groups(a, b)
    n_groups = int(of_a[-1]) + 1
    doc = np.empty(n_groups, np.int64)
    doc[of_a] = a["doc"].to_numpy()
    counts[:, 0], counts[:, 1], counts[:, 2] = n_a, n_b, np.bincount(doc, minlength=n)
    product = np.bincount(of_a, minlength=n_groups) * np.bincount(of_b, minlength=n_groups)
    np.add.at(counts[:, 3], doc, product)
    text, at = said(ids_a, of_a, ids_b, of_b)
    text = text.tobytes()
    edge = np.searchsorted(doc, np.arange(n + 1))
    for d in np.flatnonzero(good).tolist():
        hashes[d] = hashlib.sha256(text[at[edge[d]]: at[edge[d + 1]] - 1]).hexdigest()
    parts = [_summed(*x) for x in links(doc, ids_a, of_a, ids_b, of_b)]
    return counts, hashes, _summed(*map(np.concatenate, zip(*parts, strict=True)))


SCHEMA = ("block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>, "
          "first array<int>, place array<int>, times array<long>, pair array<long>, docs array<long>")


def _block_rows(model_a: str, model_b: bytes, limit: int):
    def run(batches):
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        tb.lean()
        kept_a = for_worker(f"plain_{hash(model_a)}", lambda: Kept(ByteLevel(model_a, plain_specials=True), SEGMENTS))
        kept_b = for_worker(f"pieces_{hash(model_b)}", lambda: Kept(Pieces(model_b), SEGMENTS))
        number, part = 0, TaskContext.get().partitionId()
        ids, counts, hashes, docs, pairs, times, size = [], [], [], [], [], [], 0

        def flushed():
            count, doc = np.concatenate(counts), np.concatenate(docs)
            pair, place, held = np.unique(np.concatenate(pairs), return_inverse=True, return_counts=True)
            first = np.searchsorted(doc, np.arange(len(ids) + 1))
            lists = [ids, *count.T, hashes, first.astype(np.int32), place.astype(np.int32), np.concatenate(times), pair, held]
            kinds = [pa.int64()] * 5 + [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array([part << 32 | number]), *[pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, t)) for x, t in zip(lists, kinds, strict=True)]],
                names=["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "first", "place", "times", "pair", "docs"])

        for b in batches:
            of = b.column(0).to_pylist()
            for r0, r1, data, offsets in tb.chunks(b.column(1), CHUNK):
                if size and size + len(data) > limit:
                    yield flushed()
                    ids, counts, hashes, docs, pairs, times, size, number = [], [], [], [], [], [], 0, number + 1
                count, sha, (doc, pair, n) = align(data, offsets, kept_a, kept_b)
                docs.append(doc + len(ids))
                ids += of[r0:r1]
                counts.append(count)
                hashes += sha
                pairs.append(pair)
                times.append(n)
                size += len(data)
        if ids:
            yield flushed()
    return run


def _document_rows(block: pa.Table, known: pa.Table) -> pa.Table:
    """A block and the counts of its pairs, to documents."""
    forget()  # the encoders of tasks before
    tb.lean()
    row = {name: block[name][0] for name in block.column_names}
    lists = {name: x.values for name, x in row.items() if name not in ("block", "n_pairs")}
    first, place, times = (lists[x].to_numpy().astype(np.int64) for x in ("first", "place", "times"))
    at, upto = known["at"].to_numpy(), []
    for name in ("best", "n"):
        of = np.zeros(row["n_pairs"].as_py(), np.int64)
        of[at] = known[name].to_numpy()
        total = np.concatenate([[0], np.cumsum(times * of[place])])
        upto.append(pa.array(total[first[1:]] - total[first[:-1]]))
    return pa.Table.from_arrays([*[lists[x] for x in ("doc_id", "n_a", "n_b", "n_groups", "n_links")], *upto, lists["groups_sha256"]],
                                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def linked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_a: str | None = None, model_b: str | None = None,
           block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Blocks of aligned documents, and the documents that hold each id pair linked: ``pair`` (a * 2**32 + b), ``n``, ``best``; both stored.

    ``best`` tells whether the count is the highest of the pair's first id.
    """
    import public_tokenizers

    with open(model_a or public_tokenizers.path(MODEL_A), encoding="utf-8") as f:
        first = f.read()
    with open(model_b or public_tokenizers.path(MODEL_B), "rb") as f:
        second = f.read()  # 2 MB both; they go to the tasks, which need no files
    spaced = F.concat(F.lit(" "), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    given = docs.select(F.col(f"`{id_col}`").try_cast("long").alias("doc_id"), spaced.alias("text"))
    blocks = stored(given.mapInArrow(_block_rows(first, second, block), SCHEMA), "aligned-blocks", most=FILE_BLOCKS)
    held = blocks.select(F.explode(F.arrays_zip("pair", "docs")).alias("x")).groupBy("x.pair").agg(F.sum("x.docs").alias("n"))
    held = stored(held, "linked-pairs").withColumn("a", F.shiftright("pair", 32))
    top = held.groupBy("a").agg(F.max("n").alias("top"))  # a row for each id of the first vocabulary at most
    return blocks, stored(held.join(F.broadcast(top), "a").select("pair", "n", (F.col("n") == F.col("top")).cast("long").alias("best")), "counted-pairs")


def aligned(docs: DataFrame, **options) -> DataFrame:
    """One row for each document: counts of tokens, groups and links, links under their first id's best, summed counts, hash of the groups."""
    with scratch(docs.sparkSession) as keep:
        blocks, pairs = linked(docs, **options)
        wanted = blocks.select("block", F.posexplode("pair").alias("at", "pair"))
        known = wanted.join(pairs, "pair").select(F.col("block").alias("of"), "at", "n", "best")
        lists = blocks.select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "first", "place", "times", F.size("pair").alias("n_pairs"))
        out = stored(lists.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(
            _document_rows, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"), "alignment")
        keep(out)
    return out
