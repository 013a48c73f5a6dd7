"""Files of token ids against the tokenizer itself, and their Elias-Fano codes."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from riskloom.llm import catalog, id_files, segments

SCHEMA = "doc_id long, text string, start string, ids string"
BITS = [" ", "  ", "\n", "\nNew", "end.", ";x", "\t", "a", "the", "don't", "'s", ",", "!", "é", "ß", "日本", " ", " ", "　", "\u0085", "▁", "<|endoftext|>", "</s>",
        "<0x41>", "23", "😀", "\x00", "é", "\r\n", "ａ"]


def texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def laid(given):
    raw = [t.encode() for t in given]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]).astype(np.int64)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_select_finds_every_number():
    rng = np.random.default_rng(0)
    for n, top in [(1, 0), (1, 1 << 61), (3, 5), (700, 3), (1000, 10 ** 12), (5000, 5000), (257, (1 << 62) - 1)]:
        values = np.sort(rng.integers(0, top + 1, n))
        code = id_files.EliasFano(id_files.EliasFano.pack(values))
        assert (code.select(np.arange(n)) == values).all()
        some = rng.integers(0, n, 40)
        assert (code.select(some) == values[some]).all()
    assert len(id_files.EliasFano(id_files.EliasFano.pack(np.zeros(0, np.int64))).select(np.zeros(0, np.int64))) == 0


def test_code_is_near_the_least_space():
    values = np.cumsum(np.random.default_rng(1).integers(1, 2000, 100_000))
    bits = 8 * len(id_files.EliasFano.pack(values)) / len(values)
    assert bits < 2 + np.log2(values[-1] / len(values)) + 0.5  # 64 in a table of offsets


def test_blocks_come_back():
    for known in ([], [None, None], [None, -(1 << 63), (1 << 63) - 1], [-5, -5, 0, 7]):
        ends = np.arange(1, len(known) + 1) * 3
        part, number, ids, stop, tokens = id_files.unblock(id_files.block(4, 2, known, ends, np.arange(3 * len(known)), 2) + b"\n")
        assert (part, number, ids, stop.tolist(), tokens.tolist()) == (4, 2, known, ends.tolist(), list(range(3 * len(known))))


def test_segments_give_the_ids_of_whole_texts(tokenizer):
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        kept = segments.Kept(segments.ByteLevel(f.read(), plain_specials=False))
    given = texts(3, 3000)
    ids, first, back = kept.encode(*laid(given))
    assert back.all()
    assert [ids[a:b].tolist() for a, b in zip(first, first[1:], strict=False)] == [e.ids for e in tokenizer.encode_batch(given, add_special_tokens=False)]


@pytest.mark.parametrize("size", [id_files.IDS, 50])
def test_files_hold_every_document(spark, tokenizer, scratch, size):
    rng = random.Random(2)
    rows = [(rng.randint(-50, 400), t) for t in texts(5, 300)] + [(None, "no id"), (None, None), (7, ""), (7, ""), (8, "long " * 30_000)]
    docs = spark.createDataFrame([(*r, "mine", "mine") for r in rows], SCHEMA).repartition(6)
    id_files.write(docs, f"file://{scratch}/ids", size=size)
    got = id_files.with_starts(id_files.read(spark, f"file://{scratch}/ids")).collect()
    want = sorted((i is not None, i or 0, e.ids + [0]) for (i, t), e in
                  zip(rows, tokenizer.encode_batch([t or "" for _, t in rows], add_special_tokens=False), strict=True))
    found = sorted((r.doc_id is not None, r.doc_id or 0, np.frombuffer(r.ids, "<u4").tolist()) for r in got)
    assert found == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [x[1] if x[0] else None for x in want]


def test_query(spark, tokenizer):
    rows = [(i, t) for i, t in enumerate(texts(9, 60))]
    at, want = 0, []
    for i, t in rows:
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 0]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = catalog.encoded(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert sorted(tuple(r) for r in got.collect()) == want
    assert catalog.encoded(spark.createDataFrame([], "doc_id long, text string")).count() == 0
