"""Report-text extraction over many documents: headline metric lines, meta
lines, markdown tables, metric/status lines.

Whole texts are split into line arrays and scanned with higher-order array
functions and regexes — one projection per document, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LINE_SPLIT = r"\r\n|\n|\r"
_WS_EDGES = r"^\s+|\s+$"


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, _WS_EDGES, "")


def stripped_lines(text) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    return F.transform(F.split(t, LINE_SPLIT), _strip)


def _is_metric_line(s: Column) -> Column:
    return s.startswith("**") & (s.contains("AUC") | s.contains("ECE") | F.lower(s).contains("metric"))


def extract_headline(text) -> Column:
    """First '**Headline metric...' line (label removed) or first bold line
    mentioning AUC/ECE/metric ('label: value'); else the first plain
    paragraph line (not a table, heading or code line) cut to 160 chars."""
    lines = stripped_lines(text)
    cand = F.try_element_at(F.filter(lines, lambda s: s.startswith("**Headline metric") | _is_metric_line(s)), F.lit(1))
    head = F.when(cand.startswith("**Headline metric"),
                  _strip(F.regexp_replace(cand, r"^\*\*[^*]+\*\*\s*", ""))) \
            .otherwise(_strip(F.regexp_replace(cand, r"^\*\*([^*]+)\*\*\s*:?\s*", "$1: ")))
    plain = F.try_element_at(F.filter(lines, lambda s: (s != "") & ~s.startswith("|") & ~s.startswith("#")
                                      & ~s.startswith("`")), F.lit(1))
    fallback = F.regexp_replace(F.substring(plain, 1, 160), r"\s+$", "")
    t = F.col(text) if isinstance(text, str) else text
    return F.when(t.isNull() | (t == ""), F.lit("")).when(cand.isNotNull(), head).otherwise(F.coalesce(fallback, F.lit("")))


def extract_secondary_metric(text) -> Column:
    """Second bold 'label: value' line mentioning AUC/ECE/metric with a non-empty value."""
    lines = stripped_lines(text)
    pat = r"^\*\*([^*]+)\*\*\s*:?\s*(.*)$"
    hits = F.filter(lines, lambda s: s.rlike(pat) & (s.contains("AUC") | s.contains("ECE") | F.lower(s).contains("metric"))
                    & (F.regexp_replace(_strip(F.regexp_extract(s, pat, 2)), r"^:+", "") != ""))
    second = F.try_element_at(hits, F.lit(2))
    label = _strip(F.regexp_replace(_strip(F.regexp_extract(second, pat, 1)), r":+$", ""))
    value = _strip(F.regexp_replace(_strip(F.regexp_extract(second, pat, 2)), r"^:+", ""))
    return F.when(second.isNotNull(), F.concat(label, F.lit(": "), value)).otherwise(F.lit(""))


def extract_meta_line(text, key: str) -> Column:
    """Value after '**<key>:**' on its line, stripped; null when absent."""
    t = F.col(text) if isinstance(text, str) else text
    v = F.regexp_extract(t, r"\*\*" + key + r":\*\*\s*(.+)", 1)
    return F.when(v != "", _strip(v))


def extract_line_value(text, key: str, missing: str = "—") -> Column:
    """'key: value' / 'key | value' line (case-insensitive, any line) -> value, else ``missing``."""
    t = F.col(text) if isinstance(text, str) else text
    v = F.regexp_extract(t, r"(?im)^\s*" + key + r"\s*[:|]\s*(.+)$", 1)
    return F.when(v != "", _strip(v)).otherwise(F.lit(missing))


_SEP = r"^\s*\|?\s*[-: |]+\|?\s*$"


def extract_md_table(df: DataFrame, key: str, text: str) -> DataFrame:
    """Markdown-table cells in long form ``(key, row_no, cell_no, cell)``.

    Table lines are the lines containing '|'; separator lines are skipped;
    cells are stripped; rows shorter than the document's widest row are
    padded with ''. The width is a per-document window (one document's rows).
    """
    lines = df.select(key, F.posexplode(F.split(F.col(text), LINE_SPLIT)).alias("line_no", "line"))
    t = lines.where(F.col("line").contains("|") & ~F.col("line").rlike(_SEP))
    body = F.regexp_replace(_strip(F.col("line")), r"^\|+|\|+$", "")
    t = t.select(key, "line_no", F.transform(F.split(body, r"\|"), _strip).alias("cells"))
    t = t.withColumn("row_no", F.row_number().over(Window.partitionBy(key).orderBy("line_no")) - 1)
    t = t.withColumn("_w", F.max(F.size("cells")).over(Window.partitionBy(key)))
    t = t.select(key, "row_no", "cells", F.explode(F.sequence(F.lit(0), F.col("_w") - 1)).alias("cell_no"))
    return t.select(key, "row_no", "cell_no",
                    F.coalesce(F.try_element_at("cells", F.col("cell_no") + 1), F.lit("")).alias("cell"))
