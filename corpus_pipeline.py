"""The corpus pipeline: five stages from raw documents to a training schedule.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor
kept. All but the last return the columns of ``docs``; their results are kept
apart from those columns, whatever their names. ``n_chars``, where there is such
a column, follows a changed text. No stage fails on an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm import decontaminate, mixing, near_dedup, quality_rules, suffix_dedup
from riskloom.llm.packed import KEY, keys
from riskloom.llm.shared import stored


def _carried(docs: DataFrame, *needed: str) -> DataFrame:
    """The needed columns, and all others of ``docs`` in one struct."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in needed]
    return docs.select(*needed, F.struct(*rest, F.lit(None).cast("boolean").alias("__none")).alias("__doc"))


def _restored(rows: DataFrame, docs: DataFrame, *needed: str) -> DataFrame:
    return rows.select(*[F.col(c) if c in needed else
                         F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else
                         F.col(f"__doc.`{c}`").alias(c) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without the lines that are too common at their host."""
    rows = quality_rules.judged(_carried(docs, "doc_id", "text", "source"), line_most=quality_rules.LINE_MOST).where("kept")
    return _restored(rows.withColumn("text", quality_rules.without_lines(F.col("text"), F.col("common"))), docs, "doc_id", "text", "source")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the least id; of repeated rows, one."""
    kept = near_dedup.near_classes(docs).where("keep").select(*KEY).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"), *keys("doc_id", "text")).join(kept, KEY)
    first = Window.partitionBy(*KEY).orderBy(F.lit(0))
    return rows.withColumn("__n", F.row_number().over(first)).where("__n = 1").select("__doc.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without bytes that long repeated strings cover; what is left empty by that goes."""
    rows = suffix_dedup.cut_repeats(_carried(docs, "doc_id", "text"), as_text=True)
    rows = rows.where("n_removed = 0 or length(kept) > 0").withColumnRenamed("kept", "text")
    return _restored(rows, docs, "doc_id", "text")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item of the benchmark."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    rows = decontaminate.scored(_carried(docs, "doc_id", "text"), items).where("n_items = 0")
    return _restored(rows, docs, "doc_id", "text")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training schedule over the remaining documents."""
    return mixing.mixed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("near_dedup", near_duplicates),
    ("suffix_dedup", repeated_passages),
    ("decontaminate", decontaminated),
    ("mix_sources", mix),
]

#: Signatures, alignment and bisection have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
