"""The training-data operators against brute force, on small made-up tables."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from riskloom.llm import (chat_format, decontaminate, language_id, mixing, near_dedup, quality_crf, quality_rules,
                          suffix_dedup, token_counts, url_filter)
from riskloom.llm import textbytes as tb
from riskloom.llm.components import components

DOC = "doc_id long, text string, lang string, source string, n_chars long"
VOCAB = [a + b for a in "bdfgklmnprst" for b in ("a", "e", "i", "o", "u", "an", "el", "or")]


def prose(rng, n):
    return " ".join("".join(rng.choice(VOCAB) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    shared = prose(rng, 60)
    rows = [(i, prose(rng, rng.randint(30, 200)), "en", f"s{i % 3}") for i in range(40)]
    base = prose(rng, 120)
    words = base.split()
    near = " ".join(words[:50] + ["changed"] + words[51:])
    rows += [(100, base, "en", "s0"), (101, base, "en", "s1"), (102, near, "en", "s0")]
    rows += [(110 + i, f"{prose(rng, 40)} {shared} {prose(rng, 40)}", "en", "s0") for i in range(12)]
    rows += [(130, None, None, None), (131, "", "en", "s0"), (None, "one two three", "en", "s1"), (132, "é" * 900, "en", "s2"),
             (133, prose(rng, 20_000), "en", "s2"), (134, "a\x00b " * 80, "en", "s2"), (0, rows[0][1], "en", "s0")]
    return [(*r, len(r[1] or "")) for r in rows]


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOC).repartition(3)


def clashing(docs):
    """Columns that the operators use as names of results."""
    for name in ("kept", "n_bytes", "score", "lang_pred", "n_tokens", "n_items", "best_item", "spans", "common", "label", "node", "key"):
        docs = docs.selectExpr("*", f"'mine' as {name}")
    return docs


def covered(texts, width):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i: i + width] for d in data for i in range(len(d) - width + 1))
    out = []
    for d in data:
        hit = np.zeros(len(d), bool)
        for i in range(len(d) - width + 1):
            if seen[d[i: i + width]] > 1:
                hit[i: i + width] = True
        out.append((len(d), int(hit.sum()), int((hit & ~np.r_[False, hit[:-1]][: len(hit)]).sum()),
                    hashlib.sha256(np.frombuffer(d, np.uint8)[~hit].tobytes()).hexdigest()))
    return out


def test_common_prefixes_against_brute_force():
    rng = random.Random(1)
    for _ in range(150):
        width = rng.choice([2, 3, 5, 8])
        letters = rng.choice([b"ab", b"abc", b"\0a", b"abcdefgh"])
        parts = [bytes(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(rng.randint(1, 12))]
        seen = Counter(p[i: i + width] for p in parts for i in range(len(p) - width + 1))
        want = [[i for i in range(len(p) - width + 1) if seen[p[i: i + width]] > 1] for p in parts]
        assert [list(x) for x in suffix_dedup.repeated_starts(parts, width)] == want


@pytest.mark.parametrize("hot", [suffix_dedup.HOT_BYTES, 300])
def test_suffix_dedup(spark, corpus, docs, hot):
    got = suffix_dedup.cut_repeats(clashing(docs), hot_bytes=hot).collect()
    found = Counter((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got)
    assert found == Counter((d[0], *w) for d, w in zip(corpus, covered([d[1] for d in corpus], 200), strict=True))
    assert got[0].label == "mine"


def test_probminhash_estimates_similarity():
    rng = np.random.default_rng(0)
    a = np.sort(rng.integers(0, 2 ** 62, 300).astype(np.uint64))
    b = np.sort(np.concatenate([a[:250], rng.integers(0, 2 ** 62, 30).astype(np.uint64)]))
    wa, wb = rng.integers(1, 4, len(a)).astype(float), rng.integers(1, 4, len(b)).astype(float)
    sig = near_dedup.probminhash(np.repeat([0, 1], [len(a), len(b)]), np.concatenate([a, b]), np.concatenate([wa, wb]), 2, 4096)
    da, db = dict(zip(a.tolist(), wa, strict=True)), dict(zip(b.tolist(), wb, strict=True))
    exact = sum(1 / sum(max(da.get(x, 0) / da[d], db.get(x, 0) / db[d]) for x in da.keys() | db.keys()) for d in da.keys() & db.keys())
    assert near_dedup.similarity(a, wa, b, wb) == pytest.approx(exact)
    assert (sig[0] == sig[1]).mean() == pytest.approx(exact, abs=0.03)


def test_bound_holds(spark):
    from pyspark.sql import functions as F
    rng = np.random.default_rng(4)
    rows = []
    for _ in range(2000):
        a = np.sort(rng.choice(30, rng.integers(1, 30), replace=False)).astype(np.uint64)
        b = np.sort(np.unique(np.where(rng.random(len(a)) < 0.8, a, rng.integers(30, 60, len(a))))).astype(np.uint64)
        wa, wb = (1.0 + rng.integers(0, 4, len(x)) * (rng.random(len(x)) < rng.choice([0, 0.1, 0.9])) for x in (a, b))
        rows.append((float(wa[np.isin(a, b)].sum()), float(wa.sum()), float(wb.sum()), float((wb - 1).sum()), float(wb[~np.isin(b, a)].sum()), near_dedup.similarity(a, wa, b, wb)))
    found = spark.createDataFrame(rows, "shared double, s double, other double, extra double, alone double, exact double")
    given = [F.col(c) for c in ("shared", "s", "other", "extra")]
    for bound in (near_dedup._bound(*given), near_dedup._bound(*given, F.col("alone"))):
        assert found.where(bound < F.col("exact") - 1e-9).count() == 0


def test_bound_around_a_centre_holds(spark):
    from pyspark.sql import functions as F
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(2000):
        centre = rng.integers(0, 9, 40) * (rng.random(40) < 0.6)
        x, y = (np.maximum(centre + rng.integers(-3, 4, 40) * (rng.random(40) < rng.choice([0.05, 0.5])), 0)
                + (centre == 0) * rng.integers(0, 3, 40) for _ in range(2))
        if not x.any() or not y.any():
            continue
        over = (np.maximum(y - centre, 0) * (centre > 0)).sum() + np.maximum(y - 1, 0)[centre == 0].sum()
        under = (np.maximum(centre - x, 0) * (x > 0)).sum()
        (ex, wx), (ey, wy) = ((np.flatnonzero(v).astype(np.uint64), v[v > 0].astype(float)) for v in (x, y))
        rows.append((float(x[y > 0].sum()), float(x.sum()), float(y.sum()), float(np.maximum(y - 1, 0).sum()), float(y[x == 0].sum()),
                     float(over), float(under), near_dedup.similarity(ex, wx, ey, wy)))
    found = spark.createDataFrame(rows, "shared double, s double, other double, extra double, alone double, over double, under double, exact double")
    given = [F.col(c) for c in ("shared", "s", "other")] + [near_dedup._excess(F.col("under"), F.col("over"), F.col("extra"))]
    for bound in (near_dedup._bound(*given), near_dedup._bound(*given, F.col("alone"))):
        assert found.where(bound < F.col("exact") - 1e-9).count() == 0


def near_brute(texts):
    sets = []
    for t in texts:
        data = np.frombuffer((t or "").encode(), np.uint8)
        _, e, w = near_dedup.shingles(data, np.array([0, len(data)]))
        sets.append((e, w))
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(texts)):
        for j in range(i):
            if (texts[i] or "") == (texts[j] or "") or near_dedup.similarity(*sets[i], *sets[j]) >= 0.8:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(texts))]


@pytest.mark.parametrize("split", [near_dedup.SPLIT, 0])
def test_near_classes(spark, split):
    rng = random.Random(9)
    passage = prose(rng, 60)
    texts = [f"{prose(rng, 30)} {passage} {prose(rng, 40)}" for _ in range(25)]
    base = prose(rng, 150).split()
    for _ in range(25):  # copies with a few changes: some near each other only through a third
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = prose(rng, 1)
        texts.append(" ".join(words))
    texts += [texts[-1], "", None, "two words", "two words", ("again and " * 90).strip()]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = near_dedup.near_classes(spark.createDataFrame(rows, "doc_id long, text string"), split=split).collect()
    roots = near_brute(texts)
    least = {}
    for i, r in enumerate(roots):
        least[r] = min(least.get(r, i), i)
    assert {r.doc_id: r.class_id for r in got} == {i: least[r] for i, r in enumerate(roots)}
    assert all(r.keep == (r.doc_id == r.class_id) for r in got)


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(20)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for e in edges for x in e if e[0] != e[1]}


def smith_waterman(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1))
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (1 if a[i - 1] == b[j - 1] else -0.5), h[i - 1, j] - 0.5, h[i, j - 1] - 0.5)
    return h.max()


def test_alignment_against_brute_force():
    rng = np.random.default_rng(2)
    items = [rng.integers(4, 12, rng.integers(1, 20)).astype(np.uint64) * np.uint64(4) for _ in range(60)]
    texts = [rng.integers(4, 12, rng.integers(1, 40)).astype(np.uint64) * np.uint64(4) for _ in range(60)]
    assert decontaminate.align(items, texts) == pytest.approx([smith_waterman(a, b) for a, b in zip(items, texts, strict=True)])


def test_decontamination(spark, docs):
    rng = random.Random(4)
    items = [(i, prose(rng, 40)) for i in range(6)] + [(6, None), (7, "too short"), (None, prose(rng, 30))]
    words = items[1][1].split()
    for k in (3, 11, 20, 33):
        words[k] = "other"
    del words[25]
    planted = [(900, f"{prose(rng, 50)} {items[0][1]}", None, None, 0), (901, " ".join(words).upper(), None, None, 0),
               (902, prose(rng, 30) + " " + " ".join(items[2][1].split()[:10]), None, None, 0)]
    table = clashing(docs.unionByName(spark.createDataFrame(planted, DOC)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (decontaminate.BLOCK_BYTES, 400):
        got = {r.doc_id: r for r in decontaminate.scored(table, bench, block_bytes=block).collect()}
        assert {d for d, r in got.items() if r.n_items} == {900, 901}
        assert (got[900].best_item, got[900].best_score, got[901].best_item) == (0, 1.0, 1)
        assert got[900].label == "mine"


@pytest.mark.parametrize("joined", [decontaminate.JOINED, 5])
def test_decontamination_finds_edited_copies_beside_an_exact_one(spark, joined):
    rng = random.Random(14)
    items = [(i, prose(rng, 40)) for i in range(3)]
    words = items[1][1].split()
    words[4::5] = ["other"] * 8  # four words in a row stay, eight times
    rows = [(0, f"{prose(rng, 20)} {items[1][1]} {prose(rng, 20)}")]
    rows += [(1 + i, f"{prose(rng, 20)} {' '.join(words)} {prose(rng, 20)}") for i in range(60)]
    rows += [(100, f"{items[0][1]} {items[2][1]}"), (101, prose(rng, 60))]
    table, bench = (spark.createDataFrame(x, f"{k} long, text string") for x, k in ((rows, "doc_id"), (items, "item_id")))
    got = {r.doc_id: r for r in decontaminate.scored(table, bench, joined=joined).collect()}
    assert [got[i].n_items for i in (100, 101)] == [2, 0] and got[0].best_score == 1.0
    assert all((got[i].n_items, got[i].best_item) == (1, 1) and got[i].best_score >= 0.7 for i in range(1, 61))


def test_decontamination_finds_short_items_and_scripts_without_spaces(spark):
    rng = random.Random(15)
    han, thai = ("".join(chr(rng.randrange(a, b)) for _ in range(30)) for a, b in ((0x4E00, 0x9FA5), (0xE01, 0xE2E)))
    items = [(0, "Zwei Wörter"), (1, han), (2, thai), (3, "xylophone"), (4, "— !"), (5, "three words here"), (6, "𠀀𠀁")]
    other = "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(80))
    rows = [(0, f"{prose(rng, 9)}, zwei wörter! {prose(rng, 9)}"), (1, f"{other}{han[:12]}{other[0]}{han[13:]}{other}"), (2, f"ก{thai}ข"),
            (3, "Xylophone"), (4, "words three here zwei und wörter"), (5, other), (6, "three words"), (7, "前𠀀𠀁後"), (8, None), (9, "")]
    table, bench = (spark.createDataFrame(x, f"{k} long, text string") for x, k in ((rows, "doc_id"), (items, "item_id")))
    for block in (decontaminate.BLOCK_BYTES, 40):
        got = {r.doc_id: (r.n_items, r.best_item) for r in decontaminate.scored(table, bench, block_bytes=block).collect()}
        assert [got[i] for i in (0, 1, 2, 3, 7)] == [(1, 0), (1, 1), (1, 2), (1, 3), (1, 6)]
        assert [got[i][0] for i in (4, 5, 6, 8, 9)] == [0] * 5


def test_decontamination_without_items(spark, docs):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.scored(docs, empty).where("n_items > 0").count() == 0


def test_lattice_sums_all_segmentations():
    pieces = [b" a", b"a", b"b", b"ab", b" ab", b"ba", b" "]
    lattice = language_id.Lattice(sorted(pieces))
    rng = np.random.default_rng(1)
    prob = rng.random((lattice.n, 2)) / 10
    index = {p: i for i, p in enumerate(sorted(pieces))}

    def brute(word, k):
        sums = [1.0] + [0.0] * len(word)
        for e in range(1, len(word) + 1):
            for s in range(e):
                if word[s:e] in index:
                    sums[e] += sums[s] * prob[index[word[s:e]], k]
            sums[e] += sums[e - 1] * prob[-1, k]
        return math.log(sums[-1])
    words = [b" ab", b" abab", b" bcab", b" " + b"ab" * 40]
    flat = np.frombuffer(b"".join(words), np.uint8)
    size = np.array([len(w) for w in words])
    got = lattice.word_scores(flat, np.cumsum(size) - size, size, prob)
    want = [[brute(w, k) for k in (0, 1)] for w in words]
    assert got == pytest.approx(np.array(want))
    assert lattice.word_scores(flat, np.cumsum(size) - size, size, prob, scaled=True) == pytest.approx(np.array(want))


def test_long_words_are_counted_whole():
    """Expected counts of words of 200 bytes, scaled on the way, against exact fractions."""
    from fractions import Fraction
    pieces = sorted([b" a", b"a", b"b", b"ab", b" ab", b"bab", b"c"])
    lattice = language_id.Lattice(pieces)
    prob = np.full(lattice.n, 1 / lattice.n) * 2.0 ** -40  # sums far below the least double
    index = {p: i for i, p in enumerate(pieces)}
    rng = random.Random(2)
    words = [b" " + bytes(rng.choice(b"abc\xc3") for _ in range(n)) for n in (199, 8, 64, 300)]

    def brute(word):
        p = Fraction(float(prob[0]))
        edges = [(s, e, index[word[s:e]]) for s in range(len(word)) for e in range(s + 1, len(word) + 1) if word[s:e] in index]
        edges += [(s, s + 1, lattice.n - 1) for s in range(len(word))]
        up, down = [Fraction(0)] * (len(word) + 1), [Fraction(0)] * (len(word) + 1)
        up[0] = down[-1] = Fraction(1)
        for s, e, _ in sorted(edges, key=lambda x: x[1]):
            up[e] += up[s] * p
        for s, e, _ in sorted(edges, key=lambda x: -x[0]):
            down[s] += down[e] * p
        out = [Fraction(0)] * lattice.n
        for s, e, i in edges:
            out[i] += up[s] * p * down[e] / up[-1]
        return [float(x) for x in out]
    flat = np.frombuffer(b"".join(words), np.uint8)
    size = np.array([len(w) for w in words])
    got = lattice.expected(flat, np.cumsum(size) - size, size, prob, np.eye(len(words)), scaled=True)
    assert got == pytest.approx(np.array([brute(w) for w in words]), rel=1e-9, abs=1e-12)
    plain = lattice.expected(flat[200:209], np.zeros(1, np.int64), size[1:2], prob, np.ones((1, 1)))
    assert plain[0] == pytest.approx(got[1])


def test_language_id(spark):
    from pyspark.sql import functions as F
    rng = random.Random(8)
    makers = {"aa": ["ka", "lo", "mi", "ter"], "bb": ["sch", "ung", "ver", "ü"], "cc": ["ção", "que", "os", "é"]}
    rows = [(i, " ".join("".join(rng.choice(p) for _ in range(3)) for _ in range(30)).title(), k) for i, (k, p) in enumerate(list(makers.items()) * 30)]
    rows += [(1000, None, "aa"), (1001, "12 34 —!", None), (1002, "", "bb"), (1003, "schung" * 5000, None), (None, "loka miter", None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language_id.predicted(clashing(table), F.coalesce(F.col("doc_id") % 5 != 0, F.lit(False))).collect()}
    assert all(got[d].lang_pred == k for d, _, k in rows if d is not None and d < 1000)
    assert [got[d].lang_pred for d in (1000, 1001, 1002, 1003, None)] == ["und", "und", "und", "bb", "aa"]
    assert all(0 <= r.lang_score <= 1 for r in got.values())
    repeated = language_id.predicted(table.union(table), F.col("doc_id") % 5 != 0).collect()  # rows twice: each gets its result
    assert len(repeated) == 2 * len(rows)
    none = language_id.predicted(table, F.lit(False)).collect()
    assert {(r.lang_pred, r.lang_score) for r in none} == {("und", 0.0)}


def test_field_marginals_against_brute_force():
    import itertools
    rng = np.random.default_rng(0)
    emit, change, first = rng.normal(size=(7, 2)), rng.normal(size=(2, 2)), np.array([0, 3, 4, 7])
    total, node, _, _ = quality_crf.marginals(emit, change, first)
    for d, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
        z, m = 0.0, np.zeros((b - a, 2))
        for y in itertools.product([0, 1], repeat=int(b - a)):
            e = math.exp(sum(emit[a + i, y[i]] for i in range(b - a)) + sum(change[y[i], y[i + 1]] for i in range(b - a - 1)))
            z += e
            for i in range(b - a):
                m[i, y[i]] += e
        assert total[d] == pytest.approx(math.log(z)) and node[a:b] == pytest.approx(m / z)


def test_line_features_follow_the_lines():
    texts = ["", "one line", "a\n\nb b\n", "x\nx"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    near, size, first = quality_crf.line_features(data, np.cumsum([0] + [len(t) for t in texts]))
    assert size.tolist() == [len(x) for t in texts for x in t.split("\n")]
    assert np.diff(first).tolist() == [len(t.split("\n")) for t in texts]
    assert near[-1, len(quality_crf.CLASSES) + 5] == 1  # an equal line before it


def test_quality_crf_held_out(spark):
    from pyspark.sql import functions as F
    rng = random.Random(2)
    rows = []
    for i in range(160):
        bad = i % 3 == 0
        lines = [" ".join(w.upper() + "!!" if bad else w for w in prose(rng, 12).split()) for _ in range(rng.randint(1, 6))]
        rows.append((i, "\n".join(lines), 0 if bad else 1))
    docs = clashing(spark.createDataFrame([(i, t) for i, t, _ in rows] + [(900, None), (901, "")], "doc_id long, text string"))
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(5, None)], "doc_id long, quality int")
    field = quality_crf.fit(docs, labels, F.col("doc_id") % 4 != 2)
    got = {r.doc_id: r.score for r in quality_crf.scored(docs, field).collect()}
    assert all((got[i] >= 0.7) == (q == 1) for i, _, q in rows if i % 4 == 2)
    assert 0 <= got[900] == got[901] <= 1
    one = quality_crf.fit(docs, labels.where("quality = 1"), F.lit(True))
    assert {r.score for r in quality_crf.scored(docs, one).collect()} == {1.0}


def test_token_histogram(spark, docs):
    counted = token_counts.lengths(clashing(docs).select("doc_id", "text", "n_tokens")).cache()
    lengths = np.array([r.n_tokens for r in counted.collect()])
    for r in token_counts.histogram(counted).collect():
        n = r.length
        assert (r.n_docs, r.docs_at_least) == ((lengths == n).sum(), (lengths >= n).sum())
        assert (r.tokens_at_least, r.truncated_total) == (lengths[lengths >= n].sum(), np.minimum(lengths, n).sum())
        assert r.quantile == pytest.approx((lengths <= n).mean())
    assert token_counts.histogram(counted.limit(0)).count() == 0
    assert counted.where("doc_id = 130").first().n_tokens == 0


def test_base_rules(spark, corpus, docs):
    import re
    got = {r.doc_id: r for r in quality_rules.judged(clashing(docs)).collect()}
    for d, t, *_ in corpus:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        grams = Counter(tuple(words[i: i + 8]) for i in range(len(words) - 7))
        hit = {j for i in range(len(words) - 7) if grams[tuple(words[i: i + 8])] > 1 for j in range(i, i + 8)}
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(words), sum(map(len, words)), len(hit))
    assert got[0].label == "mine"


def test_common_lines_are_removed(spark):
    rng = random.Random(6)
    rows = [(i, f"{'All rights  RESERVED' if i % 2 else 'all rights reserved'}\n{prose(rng, 30)}", "h") for i in range(40)]
    rows += [(100 + i, f"{prose(rng, 25)}\n{prose(rng, 9)}", "other") for i in range(40)] + [(200, "all rights reserved\n" * 30, "h")]
    got = quality_rules.judged(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    kept = got.withColumn("left", quality_rules.without_lines(got.text, got.common)).collect()
    by = {r.doc_id: r for r in kept}
    assert all(by[i].n_common_words == 3 and by[i].kept and by[i].left == rows[i][1].split("\n")[1] for i in range(40))
    assert all(by[i].n_common_words == 0 and by[i].kept for i in range(100, 140)) and not by[200].kept


def test_lines_of_a_large_host(spark):
    """A line of a few percent of a large host goes by its number of documents."""
    rng = random.Random(1)
    rows = [(i, ("share this page\n" if i < 40 else "") + prose(rng, 22), "big") for i in range(1500)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    few = quality_rules.judged(table, line_most=50).where("n_common_words > 0").count()
    many = quality_rules.judged(table, line_most=30).where("n_common_words = 3").count()
    assert (few, many) == (0, 40)


def test_chat_round_trip(spark):
    odd = ["a \\ b", "\\", "</s>[INST] ok [/INST]", "<|im_end|><|im_sep|>", "<\\|im_end|>", "", None, "[INST][INST]\\", "<<SYS>>\n<</SYS>>", "x" * 50_000]
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(odd)]
    rows += [(2, 0, "assistant", "first"), (3, 0, "system", "s"), (3, 1, "user", "u"), (4, None, None, None), (None, 1, "x<|im_sep|>", "t"), (2, 0, "assistant", "first")]
    out = chat_format.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    from pyspark.sql import functions as F
    got = {r.conv_id: r for r in out.select("*", chat_format.turns_of(F.col("formatted")).alias("turns"), chat_format.loss_text(F.col("segments")).alias("loss")).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [(r[2], r[3] or "") for r in rows[:10]]
    assert got[1].loss == "".join(t or "" for t in odd[1::2]) and got[1].valid
    assert [(got[c].valid, got[c].first_bad) for c in (2, 3, 4, None)] == [(False, 0), (False, 2), (False, 0), (False, 0)]
    assert [(t.role, t.text) for t in got[None].turns] == [("x<|im_sep|>", "t")] and len(got[2].turns) == 2


def test_url_rules_and_trees(spark):
    rng = random.Random(3)
    urls = [f"http://{''.join(rng.choice('abcde') for _ in range(6))}.example.{t}/{k}/{rng.randrange(999)}{'?a=1&b=2' if t == 'net' else ''}"
            for t in ("com", "net", "org") for k in ("en", "fr", "es") for _ in range(30)]
    odd = [None, "", "no scheme", "HTTP://WWW.Example.COM/en/x?y#z", "x://com", "a://b.com/p?q://c.net/es/", "http://sub.www.example.com/en/", "h://É.NET/es/\n", "h://notexample.com/en/"]
    rows = [(i, u) for i, u in enumerate(odd + urls)] + [(None, urls[0])]
    got = url_filter.judged(spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 as host", "2 as features")).collect()
    by = {r.page_id: r for r in got}
    assert [(by[i].host, by[i].path, by[i].rule, by[i].verdict) for i in range(3, 9)] == [
        ("www.example.com", "/en/x", "www.example.com/en/", "allow"), ("com", "", None, by[4].verdict), ("b.com", "/p", "com/", "allow"),
        ("sub.www.example.com", "/en/", "www.example.com/en/", "allow"), ("É.net", "/es/\n", "net/es/", "block"), ("notexample.com", "/en/", "com/", "allow")]
    assert [(by[i].host, by[i].path, by[i].rule) for i in range(3)] == [("", "", None)] * 3
    assert {r.verdict for r in got} == {"allow", "block"} and len(got) == len(rows)
    net = [r for r in got if (r.host or "").endswith(".net") and r.rule is None]
    assert net and all(r.verdict == "block" for r in net)  # as their host's suffix is blocked elsewhere
    long = "h://" + "a" * 50_000 + ".net/fr/" + "x" * 50_000
    assert url_filter.judged(spark.createDataFrame([(1, long)], "page_id long, url string")).first().rule == "net/fr/"
    assert url_filter.judged(spark.createDataFrame([], "page_id long, url string")).count() == 0
    only = url_filter.judged(spark.createDataFrame([(1, "h://q.org/")], "page_id long, url string")).first()
    assert (only.verdict, only.rule) == ("allow", None)


def test_a_hot_url_is_one_row_of_the_fit(spark, monkeypatch):
    from pyspark.sql import functions as F
    kept = []
    monkeypatch.setattr(url_filter, "stored", lambda df, name: kept.append(df.cache()) or kept[-1])
    rng = random.Random(4)
    rows = [(i, "http://hot.net/es/1") for i in range(3000)]
    rows += [(5000 + i, f"http://h{i}.{'com' if i % 2 else 'net/fr'}/{rng.randrange(99)}") for i in range(1000)]
    table = spark.createDataFrame(rows, "page_id long, url string")
    got = url_filter.judged(table, fit_rows=200, learn=F.col("page_id") % 5 != 0)
    sample = kept[0].collect()
    assert 100 < len(sample) < 320 and max(r.weight for r in sample) in (1.0, 2400.0)
    assert sum(r.f_suffix1_rate for r in sample if r.label) / sum(r.label for r in sample) < 1  # own labels are left out
    held = [r for r in got.where("page_id % 5 = 0 and page_id >= 5000").collect()]
    assert sum((r.score > 0.5) == (r.rule != "com/") for r in held) / len(held) > 0.9


def test_mixing(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, rng.randint(5, 60)), "big" if i % 3 else f"s{i % 5}") for i in range(1500)] + [(5000, None, "none"), (5001, "", None), (None, "a b c", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan, t, budget = mixing.weights(docs.select("source", mixing.word_tokens(docs.text).alias("tokens")).where("source is not null"), max_repeats=1.5)
    table = plan.collect()
    assert max(r.quota / r.tokens for r in table) == pytest.approx(1.5, abs=1e-6) and 0 < t < 1
    flat, t, _ = mixing.weights(docs.select("source", mixing.word_tokens(docs.text).alias("tokens")).where("source is not null"), target_entropy=1.2)
    assert -sum(r.weight * math.log(r.weight) for r in flat.collect()) == pytest.approx(1.2, abs=1e-6)
    out = mixing.mixed(docs, max_repeats=1.5, block_tokens=4000).toPandas()
    used, weight = out.groupby("source").n_tokens.sum(), out.groupby("source").weight.first()
    total = sum(len(r[1].split()) for r in rows if r[1])
    assert all(0 <= used[s] - weight[s] * total < 60 for s in used.index)  # the last document crosses the quota
    full = out[out.epoch == 0].groupby("source").size()
    sizes = Counter(r[2] for r in rows if r[1])
    assert all(full[s] == sizes[s] for s in full.index if s.startswith("s"))
    assert not out.duplicated(["doc_id", "source", "epoch"]).any() and 5000 not in set(out.doc_id)
    assert mixing.mixed(docs.limit(0)).count() == 0


def test_empty_tables(spark):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame([], DOC)
    assert suffix_dedup.cut_repeats(docs).count() == near_dedup.near_classes(docs).count() == quality_rules.judged(docs).count() == 0
    assert language_id.predicted(docs, F.lit(True)).count() == token_counts.lengths(docs).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_crf.scored(docs, quality_crf.fit(docs, labels, F.lit(True))).count() == 0
    assert chat_format.formatted(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    assert url_filter.judged(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_words_match_python():
    texts = ["Ein  Wort\tÄ b", "", "x" * 5, " a\x00b "]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    starts, ends, hashes, first = tb.words(data, offsets, tb.word_table(lower=False))
    assert [data[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)] == [w for t in texts for w in t.split()]
    assert np.diff(first).tolist() == [len(t.split()) for t in texts] and len(set(hashes.tolist())) == len(hashes)
