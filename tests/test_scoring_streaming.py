"""Scoring job semantics, merge idempotence, streaming collector = batch."""

import hashlib
import os

from pyspark.sql import functions as F

from conftest import SF001
from riskloom.operators import scoring as SC
from riskloom.streaming import collect as CO
from riskloom.streaming.collect import stream_collect, stream_coverage


def hash_scorer(salt=""):
    """Deterministic scorer for dry runs: a keyed hash of the prompt; one call in 20 raises."""
    def score(prompt):
        h = int(hashlib.md5((prompt + salt).encode()).hexdigest()[:8], 16)
        if h % 20 == 0:
            raise RuntimeError("no answer")
        return '{"p": %.3f}' % ((h % 1000) / 1000.0)
    return score


def _cache(spark, rows):
    return spark.createDataFrame(rows, SC.CACHE_SCHEMA)


def test_score_batch_error_path_and_parse(spark):
    req = spark.createDataFrame([(i, "natural", f"prompt {i}") for i in range(200)],
                                "row_id long, prompt_format string, prompt string")
    out = SC.score_batch(req, hash_scorer(), n_partitions=4).collect()
    assert len(out) == 200
    errs = [r for r in out if r.response.startswith("Error: ")]
    assert errs and all(r.parsed_p is None for r in errs)
    ok = [r for r in out if not r.response.startswith("Error")]
    assert all(0.0 <= r.parsed_p <= 1.0 for r in ok)


def test_merge_never_overwrites_good_and_is_idempotent(spark):
    base = _cache(spark, [(1, "a", "good", 0.3), (2, "a", "Error: x", None), (3, "a", "Error: y", None)])
    retry = _cache(spark, [(1, "a", "Error: z", None), (2, "a", '{"p": 0.9}', 0.9)])
    m1 = SC.merge_update_nonnull(base, retry)
    m2 = SC.merge_update_nonnull(m1, retry)
    got = sorted((r.row_id, r.response, r.parsed_p) for r in m1.collect())
    assert got == [(1, "good", 0.3), (2, '{"p": 0.9}', 0.9), (3, "Error: y", None)]
    assert sorted(m2.collect()) == sorted(m1.collect())


def test_anti_pending_counts_cached_errors_as_done(spark):
    req = spark.createDataFrame([(1, "a", "p"), (2, "a", "p"), (3, "a", "p")], "row_id long, prompt_format string, prompt string")
    cache = _cache(spark, [(1, "a", "Error: x", None)])
    assert sorted(r.row_id for r in SC.anti_pending(req, cache).collect()) == [2, 3]


def test_stream_collect_equals_batch_and_resumes(spark, scratch):
    src = os.path.join(scratch, "chunks")
    r = spark.read.parquet(f"{SF001}/orders.parquet").select(F.col("o_orderkey").alias("row_id"))
    base = r.crossJoin(spark.createDataFrame([("structured",), ("natural",)], "prompt_format string"))
    first = base.select("row_id", "prompt_format", F.lit("Error: x").alias("response"), F.lit(None).cast("double").alias("parsed_p"))
    first.write.parquet(os.path.join(src, "c1"))
    out, ck = os.path.join(scratch, "out"), os.path.join(scratch, "ck")
    stream_collect(spark, src, out, ck)
    # a later chunk arrives: it overrides every pair; the collector resumes from its checkpoint
    second = base.where(F.col("row_id") % 2 == 0).select("row_id", "prompt_format",
                                                         F.lit('{"p": 0.5}').alias("response"), F.lit(0.5).alias("parsed_p"))
    second.write.parquet(os.path.join(src, "c2"))
    got = stream_collect(spark, src, out, ck)
    batch = SC.dedupe_keep_last(spark.read.option("recursiveFileLookup", "true").parquet(src).select("*", F.col("_metadata.file_path").alias("file"),
                                                               F.col("_metadata.row_index").alias("pos")),
                                ["row_id", "prompt_format"], ["file", "pos"])
    assert got.count() == base.count()
    assert sorted(got.select("row_id", "prompt_format", "parsed_p").collect()) == \
        sorted(batch.select("row_id", "prompt_format", "parsed_p").collect())
    # by URI too, and a retry counts by its latest response
    cov = stream_coverage(spark, f"file://{src}", f"file://{scratch}/out2", f"file://{scratch}/ck2", max_files_per_trigger=1)
    n_even, n_all = r.where("row_id % 2 = 0").count(), r.count()
    assert {(x.prompt_format, x.n, x.n_valid) for x in cov.collect()} == {("structured", n_all, n_even), ("natural", n_all, n_even)}


def test_collector_keeps_earlier_rows_on_a_uri_path(spark, scratch):
    rows = spark.range(3).selectExpr("id as row_id", "'a' as prompt_format", "'x' as response", "0.5D as parsed_p")
    src, out, ck = (f"file://{scratch}/{x}" for x in ("src", "out", "ck"))
    rows.write.parquet(f"{src}/c1")
    stream_collect(spark, src, out, ck)
    rows.where("row_id = 0").write.parquet(f"{src}/c2")
    assert stream_collect(spark, src, out, ck).count() == 3


def test_resume_on_a_uri_path_scores_once(spark, scratch):
    req = spark.range(5).selectExpr("id as row_id", "'a' as prompt_format", "concat('p', id) as prompt")
    for _ in range(2):
        got = SC.score_resume(req, f"file://{scratch}/cache", lambda p: '{"p": 0.5}', n_partitions=2)
    assert got.count() == 5


def test_coverage_counts_requests_without_a_response(spark):
    req = spark.range(4).selectExpr("id as row_id", "'a' as prompt_format")
    cache = spark.range(3).selectExpr("id as row_id", "'a' as prompt_format", "case when id > 0 then 0.5D end as parsed_p")
    assert tuple(SC.parse_coverage(cache, req).first()) == ("a", 4, 2, 0.5)


def test_parse_prob_needs_whole_json_and_a_number(spark):
    from riskloom.functions import text as T
    d = spark.createDataFrame([('{"p": 1.3} sorry, say 0.2',), ('{"p": "NaN"}',), ('{"p": "0.4"}',)], "t string")
    assert [r[0] for r in d.select(T.parse_prob("t")).collect()] == [0.2, None, 0.4]


def test_score_resume_only_scores_missing_pairs(spark, scratch):
    cache_dir = os.path.join(scratch, "cache")
    req = spark.createDataFrame([(i, "natural", f"p{i}") for i in range(50)],
                                "row_id long, prompt_format string, prompt string")
    first = SC.score_resume(req.where("row_id < 20"), cache_dir, lambda p: '{"p": 0.5}', n_partitions=2)
    assert first.count() == 20
    full = SC.score_resume(req, cache_dir, hash_scorer(), n_partitions=2)
    assert full.count() == 50
    # the first 20 pairs were not re-scored: they keep the first scorer's answer
    assert full.where("row_id < 20 and parsed_p = 0.5").count() == 20
    assert full.select("row_id", "prompt_format").distinct().count() == 50


def test_fitted_scorer_reads_every_format(spark):
    import pytest
    train = spark.createDataFrame([(0, 0)] * 30 + [(0, 1)] * 10 + [(3, 1)] * 20 + [(None, 1)], "v long, y int")
    score = SC.fit_rate_scorer(train, "v", "y", smoothing=20.0)
    said = '{"p": %.3f}' % ((20 + 0.5 * 20) / 40)
    assert score('  "number_inpatient": "3",') == said == score("and 3 inpatient stay(s).") == score("dx, IP 3 | ER 0")
    assert score("12 inpatient stay(s).") == '{"p": 0.500}'  # unseen: the overall rate
    with pytest.raises(ValueError, match="many"):
        score("nothing here")
    with pytest.raises(ValueError, match="more than 1"):
        SC.fit_rate_scorer(train, "v", "y", most_levels=1)


def test_a_batch_writes_its_own_rows_only_and_replays(spark, scratch):
    def batch(lo, hi, file, p):
        return spark.range(lo, hi).selectExpr("id as row_id", "'a' as prompt_format", "'x' as response", f"{p}D as parsed_p", f"'{file}' as file", "id as pos")

    def written(name):
        return spark.read.parquet(f"{scratch}/out/data/{name}").count()
    out = f"{scratch}/out"
    CO.upsert(batch(0, 2000, "f1", 0.1), 0, out, 8)
    CO.upsert(batch(1990, 2010, "f2", 0.2), 1, out, 8)
    CO.upsert(batch(1990, 2010, "f2", 0.2), 1, out, 8)  # the epoch comes again
    assert written("delta-0000000001") == 20 and not CO.path_exists(spark, f"{out}/data/base-0000000001")
    got = {r.row_id: r.parsed_p for r in CO.collected(spark, out).collect()}
    assert len(got) == 2010 and got[1989] == 0.1 and got[1990] == 0.2 and got[2009] == 0.2
    CO.upsert(batch(0, 3000, "f0", 0.3), 2, out, 8)  # an older file: only its new keys count; buckets are merged
    assert CO.path_exists(spark, f"{out}/data/base-0000000002")
    again = {r.row_id: r.parsed_p for r in CO.collected(spark, out).collect()}
    assert len(again) == 3000 and again[0] == 0.1 and again[1990] == 0.2 and again[2999] == 0.3
    assert "data/delta-0000000000" in CO.vacuum(spark, out) and CO.collected(spark, out).count() == 3000
    assert CO.collected(spark, f"{scratch}/none").count() == 0


def test_more_chunks_are_not_more_files(spark, scratch):
    from riskloom.plans import streaming_catalog as ST
    n = (ST.JOBS + 40) * 1000  # a chunk for each 1000 keys
    orders = spark.range(0, n, 250).selectExpr("id as o_orderkey", "id % 7 as o_custkey", "'O' as o_orderstatus", "1.0D as o_totalprice",
                                               "timestamp'2020-01-01' as o_orderdate", "'1' as o_orderpriority")
    orders.repartition(4).write.parquet(f"{scratch}/orders.parquet")
    src = ST._write_chunks(spark, scratch, scratch)
    files = spark.read.option("recursiveFileLookup", "true").parquet(src).where(~F.col("_metadata.file_path").contains("/rerun/"))
    assert files.count() == n // 250 * 3
    assert files.select("_metadata.file_path").distinct().count() <= ST.JOBS


def test_a_delta_holds_the_last_row_of_each_key(spark, scratch):
    jobs = spark.range(2000).selectExpr("id % 50 as row_id", "'a' as prompt_format", "'x' as response", "0.5D as parsed_p", "'f' as file", "id as pos")
    CO.upsert(jobs, 0, f"{scratch}/out", 4)
    got = CO.collected(spark, f"{scratch}/out").collect()
    assert len(got) == 50 and min(r.pos for r in got) == 1950
    assert spark.read.parquet(f"{scratch}/out/data/delta-0000000000").count() == 50


def test_pending_requests_need_no_distinct_cache(spark):
    req = spark.range(3).selectExpr("id as row_id", "'a' as prompt_format", "'p' as prompt")
    cache = spark.range(8).selectExpr("id % 2 as row_id", "'a' as prompt_format")
    out = SC.anti_pending(req, cache)
    assert [r.row_id for r in out.collect()] == [2]
    assert "Aggregate" not in out._jdf.queryExecution().optimizedPlan().toString()
