"""Diagnosis-code bucketing as one native CASE expression (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# a code is numeric only if the whole trimmed text is a plain decimal number;
# guards engine casts that accept suffixes such as '5d'
NUMERIC_RE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# FIXED VALUES: (bucket, [low, high) ranges, whole-number codes), first match wins
ICD9_RANGES = (
    ("Circulatory", ((390, 460),), (785,)),
    ("Respiratory", ((460, 520),), (786,)),
    ("Digestive", ((520, 580),), (787,)),
    ("Injury", ((800, 1000),), ()),
    ("Musculoskeletal", ((710, 740),), ()),
    ("Genitourinary", ((580, 630),), (788,)),
    ("Neoplasms", ((140, 240),), ()),
)


def icd9_bucket(code) -> Column:
    """Code -> one of 9 buckets. Order: missing/'?' -> Other; '250..' -> Diabetes;
    'V'/'E' -> Other; non-numeric -> Other; numeric ranges in table order; else Other.
    ``int(x) == c`` is written as ``c <= x < c + 1`` (same for positive codes)."""
    c = F.col(code) if isinstance(code, str) else code
    s = F.trim(c)
    num = F.when(s.rlike(NUMERIC_RE), s.try_cast("double"))
    e = F.when(c.isNull() | (c == "?"), "Other").when(s.startswith("250"), "Diabetes")
    e = e.when(s.startswith("V") | s.startswith("E"), "Other").when(num.isNull(), "Other")
    for name, ranges, ints in ICD9_RANGES:
        cond = None
        for lo, hi in ranges:
            t = (num >= lo) & (num < hi)
            cond = t if cond is None else cond | t
        for v in ints:
            cond = cond | ((num >= v) & (num < v + 1))
        e = e.when(cond, name)
    return e.otherwise("Other")


def sql_icd9_bucket(code: str) -> str:
    """DuckDB twin of :func:`icd9_bucket`."""
    s = f"trim({code})"
    num = f"(case when regexp_matches({s}, '{NUMERIC_RE}') then try_cast({s} as double) end)"
    parts = [f"case when {code} is null or {code} = '?' then 'Other'",
             f"when starts_with({s}, '250') then 'Diabetes'",
             f"when starts_with({s}, 'V') or starts_with({s}, 'E') then 'Other'",
             f"when {num} is null then 'Other'"]
    for name, ranges, ints in ICD9_RANGES:
        conds = [f"({num} >= {lo} and {num} < {hi})" for lo, hi in ranges]
        conds += [f"({num} >= {v} and {num} < {v + 1})" for v in ints]
        parts.append(f"when {' or '.join(conds)} then '{name}'")
    return " ".join(parts) + " else 'Other' end"
