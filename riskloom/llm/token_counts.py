"""Token counts: an exact histogram of encoded lengths, and what it says for every context limit.

Documents are encoded whole with a public byte-level BPE vocabulary; special
token strings in a text are ordinary text. Counting documents by length is one
aggregation; all else follows from the histogram, which has a row for each
length that occurs:

* ``n_docs``, ``n_tokens``: documents of this length, and their tokens;
* ``docs_at_least``, ``tokens_at_least``: suffix sums from this length up;
* ``truncated_total``: tokens left if every document is cut to this length;
* ``quantile``: share of documents of this length or less.

Null and empty texts have length 0. An empty table has an empty histogram.

Suffix sums are taken in two steps, by ranges of lengths and within each, so no
task holds the whole histogram.
"""

from __future__ import annotations

import base64

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import textbytes as tb

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# fixed value: the vocabulary's word pattern
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RANGE = 256  # lengths in a range


def lengths(docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """All columns of ``docs`` but the text, with ``n_tokens``."""
    with open(vocabulary, "rb") as f:
        raw = f.read()  # about 1 MB; goes to the tasks, which need no file
    rest = [c for c in docs.columns if c not in (text_col, "n_tokens")]
    given = docs.select(*[F.col(f"`{c}`") for c in rest], F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("__text"))
    schema = given.select(*[F.col(f"`{c}`") for c in rest]).schema.add("n_tokens", "long")
    n, names = len(rest), schema.names

    def run(batches):
        import tiktoken

        tb.lean()
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
        encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for whole in batches:
            for b in tb.slices(whole, n):
                count = [len(encoding.encode_ordinary(x)) for x in b.column(n).to_pylist()]
                yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(count, pa.int64())], names=names)

    return given.mapInArrow(run, schema)


def histogram(counted: DataFrame, length_col: str = "n_tokens") -> DataFrame:
    """The histogram of ``length_col`` with suffix sums; see the module."""
    rows = (counted.groupBy(F.col(length_col).alias("length")).agg(F.count(F.lit(1)).alias("n_docs"))
            .withColumn("n_tokens", F.col("length") * F.col("n_docs")).withColumn("range", F.floor(F.col("length") / RANGE)))
    ranges = rows.groupBy("range").agg(F.sum("n_docs").alias("d"), F.sum("n_tokens").alias("t"))
    above = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    later = ranges.select("range", F.coalesce(F.sum("d").over(above), F.lit(0)).alias("d"), F.coalesce(F.sum("t").over(above), F.lit(0)).alias("t"))
    total = ranges.agg(F.struct(F.sum("d").alias("d"), F.sum("t").alias("t")))
    upward = Window.partitionBy("range").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    out = (rows.join(later, "range").withColumn("all", total.scalar())
           .withColumn("docs_at_least", F.col("d") + F.sum("n_docs").over(upward))
           .withColumn("tokens_at_least", F.col("t") + F.sum("n_tokens").over(upward)))
    return out.select(
        "length", "n_docs", "n_tokens", "docs_at_least", "tokens_at_least",
        (F.col("all.t") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")).alias("truncated_total"),
        ((F.col("all.d") - F.col("docs_at_least") + F.col("n_docs")) / F.col("all.d")).alias("quantile"))
