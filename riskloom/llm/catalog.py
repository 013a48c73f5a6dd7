"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.llm import chat_format, id_files, oracles, prefix_trie, quality_crf, quality_rules, url_filter
from riskloom.llm.alignment import aligned
from riskloom.llm.decontaminate import scored
from riskloom.llm.language_id import predicted
from riskloom.llm.mixing import mixed
from riskloom.llm.near_dedup import near_classes
from riskloom.llm.registry import ORACLE, QUERIES, query, table
from riskloom.llm.shared import fresh, scratch, stored
from riskloom.llm.suffix_dedup import cut_repeats
from riskloom.llm.token_counts import histogram, lengths


def remainder(of: int):
    """crc32 of the id as text, modulo ``of``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % of


@query("op1_url_filter")
def op1_url_filter(spark, sf_dir):
    out = url_filter.judged(table(spark, sf_dir, "pages").select("page_id", "url"))
    return out.select("page_id", "host", "path", "rule", "verdict", "score")


@query("op2_suffix_dedup")
def op2_suffix_dedup(spark, sf_dir):
    out = cut_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


@query("op3_chat_format", oracles.CHAT_FORMAT)
def op3_chat_format(spark, sf_dir):
    said = "</s>[INST] ok [/INST]"
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    out = chat_format.formatted(talks.unionByName(probe))
    turns = chat_format.turns_of(F.col("formatted"))
    loss = chat_format.loss_text(F.col("segments"))
    return (out.select("conv_id", turns.alias("turns"), loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"), "valid")
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                    F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").cast("binary"), 256).alias("turns_sha256"),
                    F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                    "formatted_chars", "valid"))


@query("op4_token_counts")
def op4_token_counts(spark, sf_dir):
    return histogram(lengths(table(spark, sf_dir, "documents").select("text")))


@query("op5_mixing")
def op5_mixing(spark, sf_dir):
    return mixed(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


@query("op6_quality_rules", oracles.QUALITY_RULES)
def op6_quality_rules(spark, sf_dir):
    out = quality_rules.judged(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_common_words", "kept")


@query("op7_decontaminate")
def op7_decontaminate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = scored(docs, table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_items", "best_item", F.col("best_score").alias("score"), (F.col("n_items") > 0).alias("contaminated"))


@query("op8_quality_crf")
def op8_quality_crf(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    field = quality_crf.fit(docs, table(spark, sf_dir, "labels"), learn=remainder(4) != 2)
    return quality_crf.scored(docs, field).select(
        "doc_id", (remainder(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op9_near_dedup")
def op9_near_dedup(spark, sf_dir):
    out = near_classes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "class_id", "class_size", "keep")


@query("op10_language_id")
def op10_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = predicted(docs, learn=remainder(5) != 0)
    return out.select("doc_id", (remainder(5) == 0).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def encoded(docs):
    """Documents as the files of their token ids have them."""
    with scratch(docs.sparkSession) as keep:
        path = fresh(docs.sparkSession, "token-ids")
        id_files.write(docs, path)
        rows = id_files.read(docs.sparkSession, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
        out = stored(id_files.with_starts(stored(rows, "encoded")), "encoded-starts")
        keep(out)
    return out.select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op11_token_ids")
def op11_token_ids(spark, sf_dir):
    return encoded(table(spark, sf_dir, "documents"))


def conversation_trie(talks):
    """Nodes of the trie of conversations that share the first turns of the conversation that begins their hundred."""
    ident = F.col("conv_id")
    with scratch(talks.sparkSession) as keep:
        turns = stored(prefix_trie.numbered(talks), "numbered")
        nodes, ends = prefix_trie.trie(*prefix_trie.rebuilt(turns, ident - F.pmod(ident, F.lit(100)), F.crc32(ident.cast("string")) % 6, 5))
        keep(nodes)
        keep(ends)
    return (nodes.join(prefix_trie.digests(ends), ["k1", "k2"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")))


@query("op12_prefix_trie")
def op12_prefix_trie(spark, sf_dir):
    return conversation_trie(table(spark, sf_dir, "conversations"))


@query("op13_alignment")
def op13_alignment(spark, sf_dir):
    return aligned(table(spark, sf_dir, "documents"))


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE)
