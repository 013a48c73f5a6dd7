"""Resumable batch text-scoring job on Spark.

Flow: ``build_requests`` (rows x formats) -> ``anti_pending`` (drop pairs
already cached) -> ``score_batch`` (hash-repartitioned, ``mapInPandas`` with an
injected scorer; a failing call becomes ``Error: ...`` text, never a failed
task) -> parse -> append to the cache -> ``dedupe_keep_last`` ->
``join_align_labels`` -> AUC per format.

Durability: the cache is a parquet table keyed by (row_id, prompt_format);
a task that dies is simply re-run (the scorer is called again for its rows),
and a job that dies resumes from ``anti_pending`` against what was committed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import text as T
from riskloom.functions.vocab import ADMISSION_TYPE_LABELS, ERROR_PREFIXES, PROMPT_FORMATS
from riskloom.operators.lookup import lookup_int_label
from riskloom.session import path_exists

CACHE_SCHEMA = "row_id long, prompt_format string, response string, parsed_p double"


def prompt_for(fmt_col: str = "prompt_format"):
    adm = lookup_int_label("admission_type_id", ADMISSION_TYPE_LABELS)
    return (F.when(F.col(fmt_col) == "structured", T.prompt_structured())
             .when(F.col(fmt_col) == "natural", T.prompt_natural(adm))
             .when(F.col(fmt_col) == "abbreviated", T.prompt_abbreviated()))


def build_requests(rows: DataFrame, key: str = "row_id",
                   formats: Sequence[str] = PROMPT_FORMATS) -> DataFrame:
    """(row_id, prompt_format, prompt): every row under every format.

    The format list is a literal array exploded in the projection: rows are
    multiplied by len(formats) in place — no join, no shuffle.
    """
    x = rows.withColumn("prompt_format", F.explode(F.array(*[F.lit(f) for f in formats])))
    return x.select(F.col(key).alias("row_id"), "prompt_format", prompt_for().alias("prompt"))


def anti_pending(requests: DataFrame, cache: DataFrame,
                 keys: Sequence[str] = ("row_id", "prompt_format")) -> DataFrame:
    """Requests whose (row, format) pair is not in the cache (cached errors count as done)."""
    return requests.join(cache.select(*keys), list(keys), "left_anti")


# fixed value: where each prompt format says how many inpatient stays there were
INPATIENT = r'"number_inpatient": "(\d+)"|(\d+) inpatient stay|\bIP (\d+)'
MOST_LEVELS = 10_000


def fit_rate_scorer(train: DataFrame, level: str, label: str, *, reader: str = INPATIENT, smoothing: float = 20.0,
                    most_levels: int = MOST_LEVELS) -> Callable[[str], str]:
    """A scorer fitted in Spark: the smoothed rate of ``label`` at each integer ``level``, found in a prompt by ``reader``.

    Only the rates go to the driver and to the tasks: at most ``most_levels``, else it
    raises. An unseen level scores the overall rate; a prompt without a level is a failed
    call. Responses are JSON with three decimals, halves up.
    """
    per = train.where(F.col(level).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(level).cast("long").alias("lv")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("double")).alias("s"))
    found = per.limit(most_levels + 1).collect()
    if not found or len(found) > most_levels:
        raise ValueError(f"{level} has no level, or more than {most_levels}")
    prior = sum(r["s"] for r in found) / sum(r["n"] for r in found)
    rates = {r["lv"]: (r["s"] + prior * smoothing) / (r["n"] + smoothing) for r in found}

    def score(prompt: str) -> str:
        import math
        import re

        hit = re.search(reader, prompt)
        if hit is None:
            raise ValueError("the prompt doesn't say how many")
        p = rates.get(int(next(g for g in hit.groups() if g is not None)), prior)
        return '{"p": %.3f}' % (math.floor(p * 1000 + 0.5) / 1000)
    return score


def score_batch(requests: DataFrame, scorer: Callable[[str], str], *, n_partitions: int | None = None,
                strict_parse: bool = True) -> DataFrame:
    """Call ``scorer`` on every prompt; output has the cache schema.

    Requests are hash-partitioned on (row_id, format) so each task holds a
    bounded, evenly sized slice (the unit of retry); Arrow batches move the
    prompts to Python and the responses back.
    """
    n = n_partitions or requests.sparkSession.sparkContext.defaultParallelism
    parts = requests.repartition(n, "row_id", "prompt_format")

    def run(batches):
        for pdf in batches:
            out = []
            for p in pdf["prompt"]:
                try:
                    out.append(scorer(p))
                except Exception as e:  # noqa: BLE001 — a failed call is data, not a failed task
                    out.append(f"Error: {e}")
            yield pd.DataFrame({"row_id": pdf["row_id"], "prompt_format": pdf["prompt_format"],
                                "response": out})

    scored = parts.mapInPandas(run, "row_id long, prompt_format string, response string")
    return scored.withColumn("parsed_p", T.parse_prob("response", strict=strict_parse))


def failed_calls(cache: DataFrame, prefixes: Sequence[str] = ERROR_PREFIXES) -> DataFrame:
    return cache.where(T.is_failed_call("response", "parsed_p", prefixes))


def merge_update_nonnull(base: DataFrame, retry: DataFrame,
                         keys: Sequence[str] = ("row_id", "prompt_format")) -> DataFrame:
    """Overwrite (response, parsed_p) of matched keys only where the retry parsed.

    Never replaces a good value with a bad one; idempotent. Produces a new
    version of the table (plain parquet has no MERGE).
    """
    r = retry.select(*keys, F.col("response").alias("_r_resp"), F.col("parsed_p").alias("_r_p"))
    j = base.join(r, list(keys), "left")
    ok = F.col("_r_p").isNotNull()
    return j.select(*keys, F.when(ok, F.col("_r_resp")).otherwise(F.col("response")).alias("response"),
                    F.when(ok, F.col("_r_p")).otherwise(F.col("parsed_p")).alias("parsed_p"),
                    *[c for c in base.columns if c not in (*keys, "response", "parsed_p")])


def dedupe_keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], *,
                     keep_order: bool = False) -> DataFrame:
    """Last row per key by ``order`` (e.g. file, position): ``max(struct(order.., rest..))``
    in a (sort) aggregate, so a hot key is combined map-side. ``keep_order``
    keeps the provenance columns (needed for incremental upserts)."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    g = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_r"))
    out = list(order) + rest if keep_order else rest
    return g.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in out])


def seed_cache(own_rows: DataFrame, earlier_caches: Sequence[DataFrame], key: str = "row_id") -> DataFrame:
    """Seed a chunk's cache from earlier caches restricted to its own rows.

    Earlier caches are unioned in preference order; a pair present in an
    earlier (preferred) cache shadows later ones.
    """
    out = None
    for i, c in enumerate(earlier_caches):
        c = c.join(own_rows.select(key), key, "left_semi").withColumn("_pref", F.lit(i))
        out = c if out is None else out.unionByName(c)
    g = out.groupBy(key, "prompt_format").agg(F.min(F.struct("_pref", "response", "parsed_p")).alias("_r"))
    return g.select(key, "prompt_format", "_r.response", "_r.parsed_p")


def parse_coverage(cache: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """Per format: n, n_valid, n_valid / n.

    ``n`` counts the requested pairs, so a request without a response lowers
    coverage; without ``requests``, the pairs in the cache.
    """
    if requests is not None:
        keys = ["row_id", "prompt_format"]
        cache = requests.select(*keys).distinct().join(cache.select(*keys, "parsed_p"), keys, "left")
    return cache.groupBy("prompt_format").agg(
        F.count(F.lit(1)).alias("n"), F.count("parsed_p").alias("n_valid")).withColumn(
        "coverage", F.round(F.col("n_valid") / F.col("n"), 6) + F.lit(0.0))


def score_resume(requests: DataFrame, cache_dir: str, scorer: Callable[[str], str], *,
                 n_partitions: int | None = None) -> DataFrame:
    """Score only pairs not yet in the cache directory and append them.

    The durability unit is a task: a committed append is never redone, a
    failed task is retried by Spark, a failed job resumes from the anti join.
    Returns the full cache after the append.
    """
    spark = requests.sparkSession
    cache = (spark.read.schema(CACHE_SCHEMA).parquet(cache_dir) if path_exists(spark, cache_dir)
             else spark.createDataFrame([], CACHE_SCHEMA))
    pending = anti_pending(requests, cache)
    score_batch(pending, scorer, n_partitions=n_partitions).write.mode("append").parquet(cache_dir)
    return spark.read.schema(CACHE_SCHEMA).parquet(cache_dir)
