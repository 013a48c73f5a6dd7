"""Quality rules: word and repetition rules for each text, and cross-document line frequency.

Words are runs of non-space characters. The base rules reject a document with
fewer than ``MIN_WORDS`` words or with more than ``REPEAT_SHARE`` percent of its
words in eight-word windows that the text holds twice or more.

Line frequency: lines with a word are lower-cased, their spaces run together,
and hashed. For each host, the documents that hold a line are counted. A line
held by more than ``LINE_DOCS`` of the host's documents, and by more than ``LINE_SHARE`` of them
or more than ``LINE_MOST``, is removed: the share alone would ask for ever more
documents the larger the host is. A document that keeps less than ``KEEP_SHARE`` of its
words is depleted and rejected.

Native throughout. A row's windows are hashed and compared inside the row, so
words aren't shuffled; only line hashes are, counted on the map side first. A
line or host of any size is thus a few rows for each task. Texts are read twice: for the
counts of each text, and for its line hashes, which are written once.

Null and empty texts have no words and fail; a long text is a row like any other. A null
host is the host ``""``. Rows that agree in id and text are one document in the line counts; each row
gets its result. An empty table gives no rows. Columns named like a result are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.exprs import SPACE, let, words_of
from riskloom.llm.packed import KEY, keys, text_of
from riskloom.llm.shared import scratch, stored

MIN_WORDS, REPEAT_SHARE, WINDOW = 20, 30, 8
LINE_SHARE, LINE_DOCS, KEEP_SHARE = 0.1, 20, 0.3
LINE_MOST = 1000  # documents of a host
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_common_words", "common", "kept")


def _covered(starts: Column) -> Column:
    """Words in windows that begin at sorted ``starts``."""
    return F.aggregate(
        F.sequence(F.lit(0), F.size(starts) - 1), F.lit(0).cast("long"),
        lambda acc, k: acc + F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - F.get(starts, k), F.lit(WINDOW))))


def repeat_words(words: Column) -> Column:
    """Words in windows of eight that occur twice or more, the first ones included."""
    def of_grams(grams: Column) -> Column:
        ranked = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
        twice = let(ranked, lambda r: F.filter(
            F.transform(r, lambda x, k: F.when((F.get(r, k - 1)["g"] == x["g"]) | (F.get(r, k + 1)["g"] == x["g"]), x["i"])), F.isnotnull))
        return (F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0).cast("long"))
                .otherwise(let(F.sort_array(twice), _covered)))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    grams = let(hashed, lambda h: F.transform(F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(h, i, WINDOW))))
    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("long")).otherwise(let(grams, of_grams))


def lines_of(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE[1:]}"))


def line_hash(line: Column) -> Column:
    return F.xxhash64(F.lower(F.array_join(words_of(line), " ")))


def base_columns(text: Column) -> Column:
    """Struct of the base counts of a text."""
    counted = let(words_of(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), repeat_words(w).alias("n_repeat_words")))
    lines = let(lines_of(text), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    symbols = (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))).cast("long")
    return let(counted, lambda c: F.struct(
        c["n_words"].alias("n_words"), c["word_chars"].alias("word_chars"), symbols.alias("n_symbols"), lines.alias("n_dup_lines"),
        c["n_repeat_words"].alias("n_repeat_words"),
        ((c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > REPEAT_SHARE * c["n_words"])).alias("base_failed")))


def common_lines(docs: DataFrame, id_col: str, text_col: str, host_col: str, line_share: float, line_docs: int,
                 line_most: int) -> tuple[DataFrame, DataFrame]:
    """Line rows (keys, host, hash, place, words) and the (host, hash) above the limits."""
    host = F.coalesce(F.col(f"`{host_col}`").cast("string"), F.lit(""))
    hashed = F.transform(lines_of(F.col("__text")), lambda x: let(words_of(x), lambda w: F.struct(
        F.xxhash64(F.lower(F.array_join(w, " "))).alias("h"), F.size(w).alias("w"))))
    slim = docs.select(*keys(id_col, text_col), host.alias("__host"), text_of(text_col).alias("__text"))
    slim = stored(slim.select(*KEY, "__host", hashed.alias("lines")), "line-hashes")
    rows = slim.select(*KEY, "__host", F.posexplode("lines").alias("place", "line")).select(*KEY, "__host", F.col("line.h").alias("h"), "place", F.col("line.w").alias("w"))
    hosts = slim.select(*KEY, "__host").distinct().groupBy("__host").agg(F.count(F.lit(1)).alias("docs"))
    held = rows.select(*KEY, "__host", "h").distinct().groupBy("__host", "h").agg(F.count(F.lit(1)).alias("n"))
    enough = F.least(line_share * F.col("docs"), F.lit(float(line_most)))
    common = held.where(F.col("n") > line_docs).join(hosts, "__host").where(F.col("n") > enough).select("__host", "h")
    return rows, common


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
           line_share: float = LINE_SHARE, line_docs: int = LINE_DOCS, keep_share: float = KEEP_SHARE,
           line_most: int = LINE_MOST) -> DataFrame:
    """``docs`` with the base counts, ``base_failed``, ``n_common_words``, ``common`` (hashes of removed lines) and ``kept``.

    These replace input columns of the same names.
    """
    with scratch(docs.sparkSession) as keep:
        rows, common = common_lines(docs, id_col, text_col, host_col, line_share, line_docs, line_most)
        lost = stored(rows.join(common, ["__host", "h"]).groupBy(*KEY, "place").agg(F.first("h").alias("h"), F.first("w").alias("w"))
                      .groupBy(*KEY).agg(F.sum("w").alias("__lost"), F.collect_set("h").alias("__common")), "common-lines")
        keep(lost)
    given = [c for c in docs.columns if c not in RESULTS]
    base = docs.select(*[F.col(f"`{c}`") for c in given], *keys(id_col, text_col), base_columns(text_of(text_col)).alias("__b"))
    out = base.join(lost, KEY, "left")
    left = F.coalesce(F.col("__lost"), F.lit(0).cast("long"))
    depleted = F.col("__b.n_words") - left < keep_share * F.col("__b.n_words")
    return out.select(*[F.col(f"`{c}`") for c in given], "__b.*", left.alias("n_common_words"),
                      F.coalesce("__common", F.array().cast("array<long>")).alias("common"), (~F.col("__b.base_failed") & ~depleted).alias("kept"))


def without_lines(text: Column, hashes: Column) -> Column:
    """The text without lines whose hash is among ``hashes``."""
    kept = F.filter(F.split(text, "\n"), lambda x: ~F.array_contains(hashes, line_hash(x)) | ~x.rlike(f"[^{SPACE[1:]}"))
    return F.when(F.size(hashes) == 0, text).otherwise(F.array_join(kept, "\n"))
