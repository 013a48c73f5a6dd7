"""The conversation prefix trie against a trie built turn by turn."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from riskloom.llm import catalog, prefix_trie
from riskloom.llm.running import running
from riskloom.llm.shared import stored

TALK = "conv_id long, turn long, role string, text string"


def brute(rows):
    talks = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            talks[c].append((turn is not None, turn or 0, role or "", text or ""))
    talks = {c: [(r, x) for _, _, r, x in sorted(t)] for c, t in talks.items()}
    whole = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(talks.get(c - c % 100, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, w in whole.items():
        for d in range(len(w) + 1):
            members[w[:d]].append(c)
    out = []
    for path, of in members.items():
        under = [p for p in members if p[: len(path)] == path]
        ends = ",".join(str(c) for c in sorted(of) if len(whole[c]) == len(path))
        out.append((min(of), len(path), min(members[path[:-1]]) if path else None, len(of),
                    sum(len(p) == len(path) + 1 for p in under),
                    sum(not any(len(q) > len(p) and q[: len(p)] == p for q in under) for p in under),
                    sum((len(members[p]) - 1) * len(p[-1][1]) for p in under if p), hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def conversations(seed):
    """Few texts, so that many conversations share turns; no ties of turn with different texts."""
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 330, 3), *range(1000, 1012), 205, -7]:
        if c % 100 == 0 and rng.random() < 0.3:
            continue
        for turn in range(rng.randint(1, 7)):
            rows.append((c, turn, rng.choice(["user", "assistant", None]) if turn else "user", rng.choice(["hello", "é 😀", "", None])))
    rows += [(400, t, "user", "over") for t in range(60)] + [(401, t, "user", "over") for t in range(60)]  # a long one, twice
    rows += [(500, 0, "user", "same")] * 3 + [(500, None, "user", "first"), (None, 0, "user", "nobody")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_against_brute_force(spark, seed):
    rows = conversations(seed)
    talks = spark.createDataFrame(rows, TALK).repartition(5).selectExpr("*", "'mine' as pos", "'mine' as k1")
    got = catalog.conversation_trie(talks).collect()
    assert Counter(tuple(r) for r in got) == brute([r for r in rows])


def test_long_end_lists_come_in_pieces(spark):
    rows = [(1000 + i, 0, "user", "hi") for i in range(250)]
    turns = stored(prefix_trie.numbered(spark.createDataFrame(rows, TALK)), "numbered")
    nodes, ends = prefix_trie.trie(turns, turns.select("conv_id"), piece=16)
    assert ends.count() >= 16 and ends.agg(F.max(F.size("ids"))).first()[0] <= 16
    said = {r.ends_sha256 for r in prefix_trie.digests(ends).collect()}
    assert said == {hashlib.sha256(",".join(str(1000 + i) for i in range(250)).encode()).hexdigest()}
    assert nodes.count() == 2


def test_trie_of_nothing(spark):
    assert catalog.conversation_trie(spark.createDataFrame([], TALK)).count() == 0


def test_running_sums_over_hot_groups(spark):
    rng = random.Random(0)
    rows = [(1, i, rng.randint(0, 9)) for i in range(3000)] + [(rng.randint(2, 9), i, rng.randint(0, 9)) for i in range(900)]
    df = stored(spark.createDataFrame(rows, "g long, i long, v long").repartition(4), "rows")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = running(df, ["g"], ["i"], {"s": "v"}).collect()
        everything = running(df, [], ["g", "i"], {"s": "v"}).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sums, total = Counter(), 0
    want, want_all = {}, {}
    for g, i, v in sorted(rows):
        sums[g] += v
        total += v
        want[g, i], want_all[g, i] = sums[g], total
    assert {(r.g, r.i): r.s for r in got} == want
    assert {(r.g, r.i): r.s for r in everything} == want_all
