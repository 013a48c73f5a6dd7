"""Hand cases for scalar expressions."""

import math

from pyspark.sql import functions as F

from riskloom.functions import text as T
from riskloom.functions.codes import icd9_bucket
from riskloom.functions.stats import wilson_bounds
from riskloom.operators.lookup import lookup_int_label


def test_icd9_bucket(spark):
    cases = [(None, "Other"), ("?", "Other"), ("250.83", "Diabetes"), ("2500", "Diabetes"),
             ("V58", "Other"), ("E909", "Other"), ("v58", "Other"), ("5d", "Other"), ("nan", "Other"),
             ("414", "Circulatory"), ("785", "Circulatory"), ("785.9", "Circulatory"), ("786", "Respiratory"),
             ("460", "Respiratory"), ("520", "Digestive"), ("787.2", "Digestive"), ("800", "Injury"),
             ("999.9", "Injury"), ("1000", "Other"), ("715", "Musculoskeletal"), ("580", "Genitourinary"),
             ("788", "Genitourinary"), ("140", "Neoplasms"), ("239.9", "Neoplasms"), (" 428 ", "Circulatory"),
             ("1e2", "Other"), ("3.9e2", "Circulatory")]
    df = spark.createDataFrame(cases, "code string, want string")
    got = df.select("want", icd9_bucket("code").alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_parse_prob(spark):
    cases = [('{"p": 0.42}', 0.42, 0.42), ('{"p": 1.3}', 1.0, 1.0), ('{"p": -2}', 0.0, 0.0),
             ('{"p": "0.4"}', 0.4, 0.4), ("The probability is 70% (0.7)", 0.7, 0.7),
             ("Error: 503 retry 1", None, 1.0), ("Error in API response: throttled", None, None),
             ("I'm sorry, I can't", None, None), ("  0.25  ", 0.25, 0.25), (None, None, None),
             ('{"q": 0.3}', 0.3, 0.3)]
    df = spark.createDataFrame([(c[0],) for c in cases], "t string")
    rows = df.select(T.parse_prob("t", strict=True).alias("s"), T.parse_prob("t", strict=False).alias("l")).collect()
    for (t, ws, wl), r in zip(cases, rows):
        assert r.s == ws, (t, r.s)
        assert r.l == wl, (t, r.l)


def test_wilson_known_values(spark):
    df = spark.createDataFrame([(0, 10), (5, 10), (10, 10), (7, 100)], "k long, n long")
    lo, hi = wilson_bounds("k", "n")
    rows = df.select(lo.alias("lo"), hi.alias("hi"), "k", "n").collect()
    z = 1.959963984540054
    for r in rows:
        p = r.k / r.n
        c = (p + z * z / (2 * r.n)) / (1 + z * z / r.n)
        h = z * math.sqrt(p * (1 - p) / r.n + z * z / (4 * r.n * r.n)) / (1 + z * z / r.n)
        assert abs(r.lo - (c - h)) < 1e-12 and abs(r.hi - (c + h)) < 1e-12
    assert abs(rows[0].lo) < 1e-12 and rows[2].hi > 0.999999


def test_clip01_keeps_null(spark):
    df = spark.createDataFrame([(None,), (1.5,), (-1.0,), (0.3,)], "x double")
    assert [r.c for r in df.select(T.clip01("x").alias("c")).collect()] == [None, 1.0, 0.0, 0.3]


def test_lookup_int_label_echoes_raw(spark):
    df = spark.createDataFrame([("1",), ("7",), ("99",), ("abc",), (None,)], "v string")
    got = [r.x for r in df.select(lookup_int_label("v", {1: "Emergency", 7: "Trauma Center"}).alias("x")).collect()]
    assert got == ["Emergency", "Trauma Center", "99", "abc", "unknown"]


def test_slug_humanize(spark):
    df = spark.createDataFrame([("iter-12_target-enc_v2",), ("plain",), ("",), ("a__b--c",)], "s string")
    rows = df.select(T.slug_humanize("s").alias("a"), T.slug_humanize("s", strip_version=True).alias("b")).collect()
    assert [r.a for r in rows] == ["Target Enc V2", "Plain", "", "A B C"]
    assert rows[0].b == "Target Enc"


def test_format_ci(spark):
    df = spark.createDataFrame([(0.6914, 0.6721, 0.7102)], "m double, lo double, hi double")
    assert df.select(T.format_ci("m", "lo", "hi").alias("t")).first().t == "0.691 (0.672–0.710)"
