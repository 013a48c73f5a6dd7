"""URL filters: allow and block rules, and boosted trees for urls that no rule fits.

A rule is ``host/path``; it fits its host and all subdomains if the url's path
starts with the rule's path. The longest rule wins, then the longer host.
Other urls are judged by gradient-boosted trees on lexical features: lengths,
depth, digit ratio, character entropy, parameter counts, and statistics of the
host's suffixes (one and two labels) over the table: how many urls share it and
the smoothed share of blocked ones among the labelled. Urls that a rule fits
are the labelled ones. The trees are fitted on about ``FIT_ROWS`` of the distinct labelled urls at
most, taken by a hash of the url and weighted by their rows, so that a url of any number of rows
is one row of the fit; the sample is written once. In it, a suffix's share leaves out the
labels of the url's own fold (of ``FOLDS``, by a hash of the url), or the trees would learn their own
labels. All urls count for the statistics and are judged.

A null or empty url, or one without ``://``, has an empty host and path and an empty
suffix; it's judged by the method like any other, and so is a long one. Without labelled urls, or
with one kind only, that kind (or allow) is the verdict. Repeated rows each get
theirs. An empty table gives no rows. Columns named like a result are replaced by it.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.exprs import let
from riskloom.llm.shared import stored

FIT_ROWS = 20_000
FOLDS = 8
TREES, DEPTH, RATE = 20, 4, 0.2
PRIOR = 20.0  # weight of the overall share in a suffix's share of blocked urls
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    raw = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(raw, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_columns(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """The rule that fits best and its verdict; null where none fits."""
    ordered = sorted(rules, key=lambda r: (-len(r[1]), -len(r[1].partition("/")[0]), r[1]))
    name = verdict = F.lit(None).cast("string")
    for kind, rule in reversed(ordered):
        rule_host, _, rule_path = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rule_path)
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def _count(text: Column, what: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))).cast("double")


def _entropy(text: Column) -> Column:
    return let(text, lambda t: F.aggregate(
        F.array_distinct(F.array_remove(F.split(t, ""), "")), F.lit(0.0),
        lambda acc, c: acc - let((F.length(t) - F.length(F.replace(t, c, F.lit("")))) / F.length(t), lambda p: p * F.log2(p))))


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    digits = F.length(F.regexp_replace(url, "[^0-9]", "")).cast("double")
    return {
        "f_length": F.length(url).cast("double"),
        "f_host_length": F.length(host).cast("double"),
        "f_path_length": F.length(path).cast("double"),
        "f_depth": _count(path, "/"),
        "f_labels": _count(host, "."),
        "f_hyphens": _count(host, "-"),
        "f_digit_ratio": digits / F.greatest(F.length(url), F.lit(1)),
        "f_entropy": _entropy(url),
        "f_host_entropy": _entropy(host),
        "f_parameters": _count(url, "="),
        "f_joins": _count(url, "&"),
        "f_fragment": F.contains(url, F.lit("#")).cast("double"),
        "f_secure": url.startswith("https").cast("double"),
        "f_dotted": F.contains(path, F.lit(".")).cast("double"),
    }


def _suffix(host: Column, labels: int) -> Column:
    return F.substring_index(host, ".", -labels)


def judged(pages: DataFrame, url_col: str = "url", rules=RULES, fit_rows: int = FIT_ROWS, learn: Column | None = None) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict`` and ``score``, the trees' probability of block.

    With ``learn``, only rows where it is true teach the trees and the suffixes' shares.
    """
    given = pages.columns
    url = F.coalesce(F.col(f"__in.`{url_col}`").cast("string"), F.lit(""))
    taught = F.lit(True) if learn is None else F.coalesce(learn, F.lit(False))
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in given]).alias("__in"), taught.alias("__learn")).withColumn("__url", url)
    rows = rows.withColumn("__host", host_of(F.col("__url"))).withColumn("__path", path_of(F.col("__url")))
    name, verdict = rule_columns(F.col("__host"), F.col("__path"), rules)
    rows = rows.withColumn("__rule", name).withColumn("__given", verdict)
    rows = rows.withColumn("__s1", _suffix(F.col("__host"), 1)).withColumn("__s2", _suffix(F.col("__host"), 2))
    shown = F.when(F.col("__learn"), F.col("__given"))
    blocked, labelled = F.sum((shown == "block").cast("long")), F.count(shown)
    rows = rows.withColumn("__fold", F.pmod(F.xxhash64("__url", F.lit(1)), F.lit(FOLDS)))
    by_suffix = rows.groupBy("__s1", "__s2", "__fold").agg(F.count(F.lit(1)).alias("n"), F.coalesce(blocked, F.lit(0)).alias("b"), labelled.alias("k"))
    total = by_suffix.agg(F.struct(F.sum("b").alias("b"), F.sum("k").alias("k"))).scalar()

    def statistics(key: str, prefix: str) -> DataFrame:
        summed = by_suffix.groupBy(key).agg(F.sum("n").alias("n"), F.sum("b").alias("b"), F.sum("k").alias("k"))
        return summed.select(key, F.log1p("n").alias(f"f_{prefix}_count"), F.col("b").alias(f"__b_{prefix}"), F.col("k").alias(f"__k_{prefix}"))

    def of_fold(key: str, prefix: str) -> DataFrame:
        return by_suffix.groupBy(key, "__fold").agg(F.sum("b").alias(f"__fb_{prefix}"), F.sum("k").alias(f"__fk_{prefix}"))

    def rate(prefix: str, b: Column | int = 0, k: Column | int = 0) -> Column:
        """Smoothed share of blocked urls of a suffix, without ``b`` blocked of ``k`` labelled ones."""
        share = F.coalesce(F.try_divide(F.col("__all.b"), F.col("__all.k")), F.lit(0.5))
        return (F.col(f"__b_{prefix}") - b + PRIOR * share) / (F.col(f"__k_{prefix}") - k + PRIOR)

    rows = rows.join(statistics("__s1", "suffix1"), "__s1").join(statistics("__s2", "suffix2"), "__s2").withColumn("__all", total)
    features = lexical(F.col("__url"), F.col("__host"), F.col("__path"))
    names = [*features, *[f"f_{p}_{x}" for p in ("suffix1", "suffix2") for x in ("count", "rate")]]
    assemble = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")

    known = rows.where(F.col("__given").isNotNull() & F.col("__learn"))
    kinds = {r["__given"]: r["n"] for r in known.groupBy("__given").agg(F.approx_count_distinct("__url").alias("n")).collect()}
    sample = None
    if len(kinds) == 2:
        share = fit_rows / sum(kinds.values())
        some = known if share >= 1 else known.where(F.pmod(F.xxhash64("__url"), F.lit(1 << 20)) < int((1 << 20) * share))
        own = ("__host", "__path", "__given", "__all", "__s1", "__s2", "__fold", "f_suffix1_count", "f_suffix2_count",
               *[f"__{x}_{p}" for p in ("suffix1", "suffix2") for x in "bk"])
        urls = some.groupBy("__url").agg(*[F.first(c).alias(c) for c in own], F.count(F.lit(1)).alias("__w"))
        urls = urls.join(of_fold("__s1", "suffix1"), ["__s1", "__fold"]).join(of_fold("__s2", "suffix2"), ["__s2", "__fold"])
        sample = urls.select(*[c.alias(k) for k, c in features.items()], "f_suffix1_count", "f_suffix2_count",
                             *[rate(p, F.col(f"__fb_{p}"), F.col(f"__fk_{p}")).alias(f"f_{p}_rate") for p in ("suffix1", "suffix2")],
                             (F.col("__given") == "block").cast("double").alias("label"), F.col("__w").cast("double").alias("weight"))
        sample = stored(sample, "labelled-urls")
        kinds = {("block" if r.label else "allow"): r["count"] for r in sample.groupBy("label").count().collect()}
    rows = rows.select("__in", "__host", "__path", "__rule", "__given", *[c.alias(k) for k, c in features.items()], "f_suffix1_count", "f_suffix2_count",
                       *[rate(p).alias(f"f_{p}_rate") for p in ("suffix1", "suffix2")])
    if sample is not None and len(kinds) == 2:
        trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=RATE, seed=7, weightCol="weight").fit(assemble.transform(sample).select("features", "label", "weight"))
        out = trees.transform(assemble.transform(rows)).withColumn("__score", vector_to_array("probability")[1])
    else:
        out = rows.withColumn("__score", F.lit(1.0 if "block" in kinds else 0.0))
    judged_as = F.coalesce("__given", F.when(F.col("__score") > 0.5, "block").otherwise("allow"))
    keep = [c for c in given if c not in ("host", "path", "rule", "verdict", "score")]
    return out.select(*[F.col(f"__in.`{c}`").alias(c) for c in keep], F.col("__host").alias("host"), F.col("__path").alias("path"),
                      F.col("__rule").alias("rule"), judged_as.alias("verdict"), F.col("__score").alias("score"))
