"""Each pipeline stage against what it must do, on a small corpus with planted cases."""

import random

import corpus_pipeline
from pyspark.sql import functions as F
from riskloom.llm.shared import stored
from tests.llm.test_operators import DOC, prose


def test_stages(spark, scratch):
    rng = random.Random(12)
    passage, base = prose(rng, 70), prose(rng, 150)
    bench = [(i, prose(rng, 40)) for i in range(3)]
    rows = [(i, f"{prose(rng, 50)}\n{prose(rng, 40)}", "en", f"s{i % 2}") for i in range(30)]
    rows += [(50, "word " * 200, "en", "s0"), (51, base, "en", "s0"), (52, base, "en", "s1"), (53, base + " more", "en", "s0")]
    rows += [(60 + i, f"{prose(rng, 60)} {passage} {prose(rng, 60)}", "en", "s0") for i in range(4)]
    rows += [(70, f"{prose(rng, 60)} {bench[1][1]} {prose(rng, 60)}", "en", "s1"), (71, None, None, None), (72, "", "en", "s1"), rows[0]]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], DOC).withColumn("kept", F.lit("mine")).withColumn("__label", F.lit(7))
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    docs.write.parquet(f"{scratch}/documents.parquet")
    ids = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, scratch), name)
        if name != "mix_sources":
            assert docs.columns == before.columns and docs.where("kept <> 'mine' or n_chars <> length(text)").count() == 0
        ids[name] = sorted(r.doc_id for r in docs.collect())
    plain = list(range(30))
    assert ids["quality_rules"] == sorted([*plain, 0, 51, 52, 53, 60, 61, 62, 63, 70])
    assert ids["near_dedup"] == sorted([*plain, 51, 60, 61, 62, 63, 70])
    assert ids["suffix_dedup"] == ids["near_dedup"]
    assert ids["decontaminate"] == sorted([*plain, 51, 60, 61, 62, 63])
    assert set(ids["mix_sources"]) <= set(ids["decontaminate"])
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, scratch).collect()) == ids["mix_sources"]


def test_lines_of_a_few_percent_of_a_large_host_go(spark, scratch):
    body = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(24)), lambda k: F.concat(F.lit("w"), F.col("doc_id"), F.lit("x"), k)), " ")
    docs = spark.range(24_000).withColumnRenamed("id", "doc_id").withColumn("source", F.lit("large"))
    line = F.when(F.col("doc_id") < 1100, "share this page\n").when(F.col("doc_id") < 2000, "kept line\n").otherwise("")
    docs = docs.withColumn("text", F.concat(line, body))
    got = corpus_pipeline.quality(spark, docs, scratch).cache()
    assert got.count() == 24_000 and got.where("text like 'share%'").count() == 0
    assert got.where("text like 'kept line%'").count() == 900


def test_one_of_each_class_stays_without_unique_ids(spark, scratch):
    rng = random.Random(13)
    base = [prose(rng, 150) for _ in range(4)]
    near = [[b, f"{b} more", f"{b} more and"] for b in base]
    rows = [(None, t) for t in near[0]] + [(7, t) for t in near[1]] + [(None, near[2][0]), (9, near[2][1]), (8, near[2][2])]
    rows += [(7, near[3][0]), (7, near[3][0]), (None, near[3][1]), (20, prose(rng, 90)), (None, prose(rng, 90))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOC)
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, scratch).collect()]
    assert len(got) == 6 and set(got) <= set(rows)
    assert [sum(t in group for _, t in got) for group in near] == [1] * 4
    assert (8, near[2][2]) in got and (7, near[3][0]) in got


def test_empty_corpus(spark, scratch):
    spark.createDataFrame([], DOC).write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    assert corpus_pipeline.run(spark, scratch).count() == 0
