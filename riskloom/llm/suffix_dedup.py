"""Suffix-array dedup: bytes covered by long strings that start more than once.

A string of ``min_bytes`` bytes that starts at two places, in one document or
two, is removed at both. Strings are judged on the input texts.

1. *Candidates.* Every window of ``min_bytes`` bytes picks the least of its
   hashed ``GRAM``-grams (leftmost on ties). Equal windows pick equal grams at
   equal offsets, so windows of different grams needn't be compared. Windows
   next to each other mostly pick the same gram; such a run is a *segment*. A
   segment whose gram is found nowhere else holds no repeat and goes.
2. *Blocks.* Equal segments of a gram become one with a multiplicity. Where a
   gram has several different ones, their bytes are gathered by gram and packed
   into blocks of at most ``BLOCK`` bytes.
3. *Threshold-bounded interval expansion* in each block: suffixes are sorted to
   a depth of ``min_bytes`` or more, and breadth-first backward extension on the
   Burrows-Wheeler transform sets common prefix lengths by increasing value, up
   to ``min_bytes - 1``. Neighbours without a value share ``min_bytes`` bytes.
4. A segment found again as a whole gives one run of bytes for each place; what
   is repeated of one found once keeps its place. Runs are removed document by
   document.

A gram whose different segments exceed ``hot_bytes`` (one passage between ever
different neighbours) can't be one block. Its windows are then grouped by a
128-bit hash of each whole window, which splits the gram as far as needed;
repeated windows next to each other become one run again.

Null texts are empty. Rows that agree in id and text are repeats of each other;
each row gets its result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm import textbytes as tb
from riskloom.llm.packed import BLOB, ID, KEY, TEXT_KEY, keys, packed, text_of, unpack
from riskloom.llm.shared import discard, scratch, stored

GRAM = 32
BLOCK = 1 << 19  # symbols of a block; ranks of 20 bits leave room for twice that
HOT_BYTES = 1 << 19
SEGMENT_SCHEMA = f"fp long, sg long, {ID} long, {TEXT_KEY} long, lo int, nw int"
PART_SCHEMA = f"fp long, sg long, {ID} long, {TEXT_KEY} long, lo int, one boolean, part binary"
RUN_SCHEMA = f"{ID} long, {TEXT_KEY} long, a int, b int"


def segments(data: np.ndarray, offsets: np.ndarray, width: int):
    """Segments of a chunk: gram hash, segment hash, first byte, windows.

    ``width`` must be at least twice ``GRAM``.
    """
    none = np.zeros(0, np.int64)
    n = len(data)
    if n < width:
        return none, none, none, none
    grams = data.astype(np.uint64) + np.uint64(1)
    step = 1
    while step < GRAM:
        grams = grams[:-step] * tb.mix(np.uint64([step]))[0] + grams[step:]
        step *= 2
    grams = tb.mix(grams)
    m = len(grams)
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(m, dtype=np.uint64)
    span, step = width - GRAM + 1, 1
    while step * 2 <= span:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if span > step:
        least = np.minimum(least[: len(least) - (span - step)], least[span - step:])
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)  # of each window of the chunk
    room = np.repeat(offsets[1:], np.diff(offsets))[: len(at)] - np.arange(len(at))
    valid = room >= width
    new = valid.copy()
    new[1:] &= ~(valid[:-1] & (at[1:] == at[:-1]))
    lo = np.flatnonzero(new)
    end = valid.copy()
    end[:-1] &= ~(valid[1:] & (at[1:] == at[:-1]))
    hi = np.flatnonzero(end)
    p, q = tb.powers(m + 1)
    total = np.zeros(m + 1, np.uint64)
    np.cumsum(grams * p[:m], out=total[1:])
    nw = hi - lo + 1
    whole = tb.mix((total[hi + span] - total[lo]) * q[lo] + nw.astype(np.uint64))
    return grams[at[lo]].view(np.int64), whole.view(np.int64), lo, nw


def _segment_rows(width: int):
    def run(batches):
        tb.lean()
        for b in batches:
            ids, tks = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
            for r0, r1, data, offsets in tb.chunks(b.column(2)):
                fp, sg, lo, nw = segments(data, offsets, width)
                if not len(fp):
                    continue
                row = np.searchsorted(offsets, lo, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp), pa.array(sg), pa.array(ids[r0:r1][row]), pa.array(tks[r0:r1][row]),
                     pa.array((lo - offsets[row]).astype(np.int32)), pa.array(nw.astype(np.int32))],
                    names=["fp", "sg", ID, TEXT_KEY, "lo", "nw"])
    return run


def sorted_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``text`` (symbols under 256, at most ``BLOCK``) in order of their first ``depth`` symbols."""
    n = len(text)
    bits = np.int64(max(1, int(n).bit_length()))
    index = np.arange(n, dtype=np.int64)
    padded = np.concatenate([text.astype(np.int64), np.zeros(8, np.int64)])
    key = np.zeros(n, np.int64)
    for j in range(5):
        key = (key << 8) | padded[j: n + j]
    have, mask = 5, (np.int64(1) << bits) - 1
    order = np.sort((key << bits) | index) if 40 + bits < 63 else None
    while True:
        suffixes = order & mask
        head = order >> bits
        rank_sorted = np.zeros(n, np.int64)
        np.cumsum(head[1:] != head[:-1], out=rank_sorted[1:])
        if have >= depth or rank_sorted[-1] == n - 1:
            return suffixes
        rank = np.zeros(n + have, np.int64)
        rank[suffixes] = rank_sorted + 1  # 0: past the end
        order = np.sort((((rank[:n] - 1) << bits | (rank[have: n + have])) << bits) | index)
        have *= 2


def shared_prefixes(text: np.ndarray, suffixes: np.ndarray, least: int, barrier: int = 0) -> np.ndarray:
    """Whether each sorted suffix shares its first ``least`` symbols with the one before it.

    Breadth-first backward extension: interval ``[lb, rb]`` holds the suffixes
    that begin with a string of ``size`` symbols. Extending it by each symbol
    before them gives intervals of longer strings; the suffix after such an
    interval gets ``size`` as its common prefix unless it has a smaller one,
    and only then is the new interval extended further. No string is extended
    over ``barrier``. What has no value after ``least`` rounds shares more.
    """
    n = len(text)
    before = text[suffixes - 1]
    order = np.argsort(before, kind="stable")
    step = np.empty(n, np.int64)  # where the suffix that is one longer stands
    step[order] = np.arange(n)
    same = before[order[1:]] == before[order[:-1]]
    later, earlier = np.full(n, n, np.int64), np.full(n, -1, np.int64)
    later[order[:-1][same]] = order[1:][same]
    earlier[order[1:][same]] = order[:-1][same]
    usable = before != barrier
    unset = np.ones(n + 1, bool)
    unset[0] = unset[n] = False
    rb = np.cumsum(np.bincount(text, minlength=256))
    lb = np.concatenate([[0], rb[:-1]])
    lb, rb = lb[rb > lb], rb[rb > lb] - 1
    fresh = unset[rb + 1]
    unset[rb + 1] = False
    lb, rb = lb[fresh], rb[fresh]
    for _ in range(1, least):
        if not len(lb):
            break
        sizes = rb - lb + 1
        stop = np.cumsum(sizes)
        at = np.arange(stop[-1]) + np.repeat(lb - (stop - sizes), sizes)
        ok = usable[at]
        last = at[ok & (later[at] > np.repeat(rb, sizes))]
        head = at[ok & (earlier[at] < np.repeat(lb, sizes))]
        nlb, nrb = np.sort(step[head]), np.sort(step[last])
        fresh = unset[nrb + 1]
        lb, rb = nlb[fresh], nrb[fresh]
        unset[rb + 1] = False
    return unset[:n]


def repeated_starts(parts: list[bytes], width: int) -> list[np.ndarray]:
    """For each part, the offsets whose ``width`` bytes start at two offsets of the parts or more."""
    raw = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    seen = np.zeros(256, bool)
    seen[raw] = True
    seen[0] = False
    dense = np.zeros(256, np.uint8)
    # a zero byte inside a part is a symbol like any other
    zero = raw == 0
    zero[ends] = False
    dense[seen] = np.arange(1, seen.sum() + 1) + bool(zero.any())
    text = dense[raw]
    if zero.any():
        text[zero] = 1
    suffixes = sorted_suffixes(text, width)
    shared = shared_prefixes(text, suffixes, width)
    # where a string of that length ends before the part does
    starts = np.zeros(len(text), bool)
    begin = ends - lengths
    for a, size in zip(begin[lengths >= width], lengths[lengths >= width], strict=True):
        starts[a: a + size - width + 1] = True
    group = np.cumsum(~shared)
    inside = starts[suffixes]
    members = np.bincount(group, weights=inside, minlength=group[-1] + 1)
    hit = np.zeros(len(text), bool)
    hit[suffixes[inside & (members[group] >= 2)]] = True
    return [np.flatnonzero(hit[a: a + size]) for a, size in zip(begin, lengths, strict=True)]


def runs(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted offsets as maximal runs ``[a, b)``."""
    cut = np.flatnonzero(np.diff(offsets) > 1)
    return offsets[np.r_[0, cut + 1]], offsets[np.r_[cut, len(offsets) - 1]] + 1


def _part_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      names=["fp", "sg", ID, TEXT_KEY, "lo", "one", "part"])


def _slice_rows(width: int):
    """Documents with the wanted segments to the rows of ``PART_SCHEMA``."""
    def run(batches):
        tb.lean()
        for b in (x for whole in batches for x in tb.slices(whole, 2)):
            rows, size = [], 0
            for i, tk, blob, wanted in zip(*(b.column(k) for k in range(4)), strict=True):
                text = unpack(blob.as_py())
                for w in wanted.as_py():
                    rows.append((w["fp"], w["sg"], i.as_py(), tk.as_py(), w["lo"], w["one"], text[w["lo"]: w["lo"] + w["nw"] + width - 1]))
                    size += len(rows[-1][-1])
                if size > 1 << 21:
                    yield _part_batch(rows)
                    rows, size = [], 0
            if rows:
                yield _part_batch(rows)
    return run


def _block_rows(width: int, block: int):
    """Parts, sorted by gram, to the runs of repeated bytes of those that are found once."""
    def solve(group):
        out = []
        for (_, _, i, tk, lo, one, _), off in zip(group, repeated_starts([g[-1] for g in group], width), strict=True):
            if one and len(off):
                a, b = runs(off)
                out.append((np.full(len(a), i), np.full(len(a), tk), a + lo, b + (lo + width - 1)))
        if not out:
            return None
        cols = [np.concatenate(c) for c in zip(*out, strict=True)]
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:2]], *[pa.array(c.astype(np.int32)) for c in cols[2:]]],
                                          names=[ID, TEXT_KEY, "a", "b"])

    def run(batches):
        tb.lean()
        ready, size, gram, gram_size = [], 0, [], 0  # whole grams, and the one that may go on
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if gram and gram[0][0] != row[0]:
                    if size and size + gram_size > block:
                        if (out := solve(ready)) is not None:
                            yield out
                        ready, size = [], 0
                    ready += gram
                    size += gram_size
                    gram, gram_size = [], 0
                gram.append(row)
                gram_size += len(row[-1]) + 1
        if size and size + gram_size > block:
            if (out := solve(ready)) is not None:
                yield out
            ready = []
        ready += gram
        if ready and (out := solve(ready)) is not None:
            yield out
    return run


def _window_rows(width: int):
    """Parts to one row for each window: two hashes, and its place; null where the part is found again as a whole."""
    def run(batches):
        tb.lean()
        for b in batches:
            ids, tks, los, ones = (b.column(k).to_numpy(zero_copy_only=False) for k in (2, 3, 4, 5))
            for r0, r1, data, offsets in tb.chunks(b.column(6)):
                size = np.diff(offsets) - width + 1
                at = np.arange(size.sum()) + np.repeat(offsets[:-1] - (np.cumsum(size) - size), size)
                m = len(data)
                p, q = tb.powers(m + 1)
                hashes = []
                for x in (data.astype(np.uint64) + np.uint64(1), tb.mix(data.astype(np.uint64) + np.uint64(7))):
                    total = np.zeros(m + 1, np.uint64)
                    np.cumsum(x * p[:m], out=total[1:])
                    hashes.append(tb.mix((total[at + width] - total[at]) * q[at]).view(np.int64))
                row = np.repeat(np.arange(r0, r1), size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[0]), pa.array(hashes[1]), pa.array(ids[row]), pa.array(tks[row]),
                     pa.array((los[row] + at - offsets[:-1][row - r0]).astype(np.int32)), pa.array(ones[row])],
                    names=["h1", "h2", ID, TEXT_KEY, "a", "one"])
    return run


def _run_rows(width: int):
    """Windows of documents, sorted by place, to runs of bytes."""
    def run(batches):
        for b in batches:
            ids, tks, at = (b.column(k).to_numpy() for k in range(3))
            new = np.ones(len(at), bool)
            new[1:] = (ids[1:] != ids[:-1]) | (tks[1:] != tks[:-1]) | (at[1:] != at[:-1] + 1)
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(at)) - 1
            yield pa.RecordBatch.from_arrays([pa.array(ids[first]), pa.array(tks[first]), pa.array(at[first]), pa.array((at[last] + width).astype(np.int32))],
                                             names=[ID, TEXT_KEY, "a", "b"])
    return run


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = 200,
                  block: int = BLOCK, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """Byte runs ``[a, b)`` of each document (keys of ``packed``) that repeated strings cover, unmerged."""
    slim = docs.select(*keys(id_col, text_col), text_of(text_col).alias("text"))
    found = slim.mapInArrow(_segment_rows(min_bytes), SEGMENT_SCHEMA)
    # written, so that both sides of the join are plain exchanges, whose hot partitions Spark splits
    twice = stored(found.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("fp"), "grams")
    found = stored(found.join(twice, "fp"), "segments")
    discard(twice)

    distinct = stored(found.groupBy("fp", "sg").agg(
        F.count(F.lit(1)).alias("c"), F.min(F.struct(ID, TEXT_KEY, "lo", "nw")).alias("at")), "distinct-segments")
    # what is found again as a whole: a row for each place
    copies = stored(found.join(distinct.where("c > 1").select("fp", "sg"), ["fp", "sg"], "left_semi")
                    .select(*KEY, F.col("lo").alias("a"), (F.col("lo") + F.col("nw") + (min_bytes - 1)).alias("b")), "copies")
    discard(found)
    several = distinct.groupBy("fp").agg(F.count(F.lit(1)).alias("k"), F.sum(F.col("at.nw") + min_bytes).alias("size"),
                                         F.min("c").alias("least")).where("k > 1 and least = 1")
    wanted = stored(distinct.join(several, "fp")
                    .groupBy(F.col(f"at.{ID}").alias(ID), F.col(f"at.{TEXT_KEY}").alias(TEXT_KEY))
                    .agg(F.collect_list(F.struct("fp", "sg", "at.lo", "at.nw", (F.col("c") == 1).alias("one"), (F.col("size") > hot_bytes).alias("hot"))).alias("wanted")), "wanted")
    discard(distinct)
    blobs = packed(docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), id_col, text_col).select(*KEY, BLOB)
    parts = stored(blobs.join(wanted, KEY).dropDuplicates(KEY).select(*KEY, BLOB, "wanted"), "parts")
    discard(wanted)

    def slices(hot: bool) -> DataFrame:
        return (parts.select(*KEY, BLOB, F.expr(f"filter(wanted, w -> w.hot = {str(hot).lower()})").alias("wanted"))
                .where("size(wanted) > 0").mapInArrow(_slice_rows(min_bytes), PART_SCHEMA))

    blocks = slices(False).repartition("fp").sortWithinPartitions("fp").mapInArrow(_block_rows(min_bytes, block), RUN_SCHEMA)
    windows = slices(True).mapInArrow(_window_rows(min_bytes), f"h1 long, h2 long, {ID} long, {TEXT_KEY} long, a int, one boolean")
    again = stored(windows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2"), "repeated-windows")
    split = (windows.where("one").join(again, ["h1", "h2"], "left_semi").select(*KEY, "a")
             .repartition(*KEY).sortWithinPartitions(*KEY, "a").mapInArrow(_run_rows(min_bytes), RUN_SCHEMA))
    return blocks.unionByName(split).unionByName(copies)


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((s["a"], s["b"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = 200,
                as_text: bool = False, **limits) -> DataFrame:
    """``docs`` with ``kept`` (what remains of the text), ``n_bytes``, ``n_removed`` and ``spans``.

    ``kept`` is binary, or with ``as_text`` a string without the characters that
    a cut left in part. ``spans`` are the maximal removed byte runs ``(a, b)``.
    Every other column but the text stays, except of these names; one row comes
    out for each row that goes in.
    """
    with scratch(docs.sparkSession) as keep:
        spans = stored(repeated_runs(docs, id_col, text_col, min_bytes, **limits).distinct()
                       .groupBy(*KEY).agg(F.collect_list(F.struct("a", "b")).alias("__spans")), "spans")
        keep(spans)
    rows = packed(docs, id_col, text_col).join(spans, KEY, "left")
    rest = [c for c in docs.columns if c not in (text_col, "kept", "n_bytes", "n_removed", "spans")]
    given = rows.select(*[F.col(f"`{c}`") for c in rest], BLOB, "__spans")
    schema = given.select(*[F.col(f"`{c}`") for c in rest]).schema
    schema = (schema.add("kept", "string" if as_text else "binary").add("n_bytes", "long").add("n_removed", "long")
              .add("spans", T.ArrayType(T.StructType().add("a", "integer").add("b", "integer"))))
    n = len(rest)

    def remove(batches):
        tb.lean()
        for b in (x for whole in batches for x in tb.slices(whole, n)):
            kept, size, removed, cuts = [], [], [], []
            for blob, spans_of in zip(b.column(n), b.column(n + 1), strict=True):
                text = unpack(blob.as_py())
                cut = merged(spans_of.as_py() or [])
                out, at = [], 0
                for x, y in cut:
                    out.append(text[at:x])
                    at = y
                kept.append(b"".join([*out, text[at:]]))
                size.append(len(text))
                removed.append(len(text) - len(kept[-1]))
                cuts.append([{"a": x, "b": y} for x, y in cut])
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:n], pa.array([x.decode(errors="ignore") for x in kept]) if as_text else pa.array(kept, pa.binary()), pa.array(size, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(cuts, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))],
                names=[*rest, "kept", "n_bytes", "n_removed", "spans"])

    return given.mapInArrow(remove, schema)
