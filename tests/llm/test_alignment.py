"""Cross-tokenizer alignment against a plain walk over each text's tokens."""

import hashlib
import itertools
import random
from collections import Counter

import public_tokenizers
import pytest

from riskloom.llm import alignment
from .test_id_files import texts


@pytest.fixture(scope="module")
def pair():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def byte_alphabet():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in shown}
    return out | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}


def brute(rows, pair):
    a, b = pair
    to_byte = byte_alphabet()
    docs, held = [], Counter()
    for doc_id, text in rows:
        cut = []
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            raw_a = [bytes(to_byte[c] for c in a.id_to_token(i)) for i in ids_a]
            raw_b = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
            if b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
                ends_a, ends_b = list(itertools.accumulate(map(len, raw_a))), list(itertools.accumulate(map(len, raw_b)))
                low = 0
                for end in sorted(set(ends_a) & set(ends_b)):
                    cut.append(([i for i, e in zip(ids_a, ends_a, strict=True) if low < e <= end], [i for i, e in zip(ids_b, ends_b, strict=True) if low < e <= end]))
                    low = end
        pairs = Counter(p for x, y in cut for p in itertools.product(x, y))
        held.update(pairs.keys())
        docs.append((doc_id, cut, pairs))
    top = {}
    for (x, _), n in held.items():
        top[x] = max(top.get(x, 0), n)
    out = []
    for doc_id, cut, pairs in docs:
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in cut)
        out.append((doc_id, sum(len(x) for x, _ in cut), sum(len(y) for _, y in cut), len(cut), sum(pairs.values()),
                    sum(n for p, n in pairs.items() if held[p] == top[p[0]]), sum(n * held[p] for p, n in pairs.items()),
                    hashlib.sha256(shown.encode()).hexdigest() if cut else ""))
    return Counter(out)


def rows():
    rng = random.Random(4)
    given = [*texts(11, 150), None, "", " ", "the end", "the end", "word " * 200, "".join(rng.choice("abcxyz") for _ in range(700)),
             "日本語のテキスト" * 20, "a▁b", "  two  spaces  ", "ＡＢＣ full width", "x" * 3000]
    return [(i, t) for i, t in enumerate(given)] + [(None, "the end"), (3, "the end")]


@pytest.mark.parametrize("block", [alignment.BLOCK, 300])
def test_alignment_against_brute_force(spark, pair, block):
    given = rows()
    docs = spark.createDataFrame(given, "doc_id long, text string").repartition(3).selectExpr("*", "'mine' as pair", "'mine' as n_a")
    got = alignment.aligned(docs, block=block).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    assert Counter(tuple(r) for r in got) == brute(given, pair)


def test_links_in_parts(monkeypatch):
    """One group of many different ids, listed in parts."""
    import numpy as np
    monkeypatch.setattr(alignment, "WIDE", 50)
    a, b = np.arange(40).repeat(2), np.arange(30)
    parts = list(alignment.links(np.zeros(1, np.int64), a, np.zeros(80, np.int64), b, np.zeros(30, np.int64)))
    assert len(parts) > 10 and max(len(p[1]) for p in parts) <= 60
    found = Counter()
    for _, pair, n in parts:
        for p, k in zip(pair.tolist(), n.tolist(), strict=True):
            found[p >> 32, p & 0xFFFFFFFF] += k
    assert found == Counter(itertools.product(a.tolist(), b.tolist()))


def test_memory_does_not_grow_with_the_blocks(spark):
    """All blocks of a task were one file, and all blocks of a partition with their counts one Arrow batch."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    docs = spark.createDataFrame([(i, f"some text {i} of its own") for i in range(60)], "doc_id long, text string").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        blocks, _ = alignment.linked(docs, block=1)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    files = [pq.ParquetFile(f.removeprefix("file:")).metadata.num_rows for f in blocks.inputFiles()]
    assert sum(files) == 60 and max(files) <= alignment.FILE_BLOCKS
    one = pa.table({"block": [7], "doc_id": [[1, None]], "n_a": [[2, 0]], "n_b": [[2, 0]], "n_groups": [[2, 0]], "n_links": [[4, 0]], "groups_sha256": [["x", ""]],
                    "first": [[0, 2, 2]], "place": [[1, 0]], "times": [[3, 1]], "n_pairs": [2]})
    got = alignment._document_rows(one, pa.table({"at": [1, 0], "n": [10, 5], "best": [1, 0]})).to_pylist()
    assert [(r["doc_id"], r["n_best"], r["count_sum"]) for r in got] == [(1, 3, 35), (None, 0, 0)]


def test_kept_segments_have_a_limit(pair):
    """A worker held 500,000 segments of each vocabulary."""
    from riskloom.llm.segments import Kept, Pieces
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        kept = Kept(Pieces(f.read()), 50)
    for k in range(40):
        kept.look_up([b" w%d" % (k * 10 + i) for i in range(10)])
        assert len(kept.known) <= 60


def test_alignment_of_nothing(spark):
    assert alignment.aligned(spark.createDataFrame([], "doc_id long, text string")).count() == 0
