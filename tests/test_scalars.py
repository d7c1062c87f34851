from __future__ import annotations

import json

from pyspark.sql import functions as F

from spanloom.functions import scalars as C


def values(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    return [r.y for r in df.select("i", column(F.col("x")).alias("y")).orderBy("i").collect()]


def test_numbers(spark):
    texts = ["", None, "12.9", "-12.9", "1e3", "abc", "Infinity"]
    assert values(spark, texts, C.safe_long) == [0, 0, 12, -12, 1000, 0, 0]
    assert values(spark, texts[:-1], C.safe_double) == [0.0, 0.0, 12.9, -12.9, 1000.0, 0.0]
    assert values(spark, ["NaN"], C.safe_long) == [0]
    assert values(spark, ["1d", "12f", "0x1p3", "2.F", "infinity"], C.safe_double) == [0.0, 0.0, 0.0, 0.0, float("inf")]


def test_timestamps(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Bogota")
    try:
        texts = [
            "2024-01-02T03:04:05Z", "2024-01-02T05:04:05+02:00", "2024-01-02T03:04:05.1234567Z",
            "2024-01-02T03:04:05", "2024-01-02", "bad", "", None, "2024-13-40T00:00:00Z", "T03:04:05Z",
            "2024-01-02T03:04:05+00", " 2024-01-02T03:04:05Z", "2024-01-02T03:04:05 UTC", "2024-01-02T03:04", "2024-1-2", "03:04:05",
        ]
        got = values(spark, texts, lambda c: F.unix_micros(C.parse_ts(c)))
        iso = values(spark, texts[:5], lambda c: C.iso_utc(C.parse_ts(c)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    base = 1704164645000000
    assert got == [base, base, base + 123456, base, 1704153600000000, None, None, None, None, None, base, base, base, base - 5000000, 1704153600000000, None]
    assert iso == [
        "2024-01-02T03:04:05+00:00", "2024-01-02T03:04:05+00:00", "2024-01-02T03:04:05.123456+00:00",
        "2024-01-02T03:04:05+00:00", "2024-01-02T00:00:00+00:00",
    ]


def test_property_bags(spark):
    texts = ["{bad", "null", "", None, '{"a.b":"1","c":null,"d":{"e":1},"f":true}']
    assert values(spark, texts, lambda c: F.size(C.properties_map(c))) == [0, 0, 0, 0, 4]
    good = ['{"a.b":"1","a.b":"2","c":null,"d":{"e":1},"f":true,"g":"\\"h\\":null"}']
    assert values(spark, good, lambda c: C.attr(C.properties_map(c), "a.b")) == ["1"]
    assert values(spark, good, lambda c: C.has_null(c, "c")) == [True]
    assert values(spark, good + [None], lambda c: C.has_null(c, "h")) == [False, False]
    assert values(spark, good, lambda c: C.attr(C.properties_map(c), "c")) == [None]
    assert values(spark, good, lambda c: C.attr(C.properties_map(c), "d")) == ['{"e":1}']
    assert values(spark, good, lambda c: C.properties_struct(c, ["a.b", "f"]).getField("a.b")) == ["2"]
    assert values(spark, good, lambda c: C.properties_struct(c, ["a.b", "f"]).getField("f")) == ["true"]


def test_long_and_loose_json(spark):
    long = F.concat(F.lit('{"user.id":"u","big":"'), F.repeat(F.lit("x"), F.lit(21_000_000)), F.lit('"}'))
    row = spark.range(1).select(F.size(C.properties_map(long)).alias("n"), C.properties_struct(long, ["user.id"]).getField("user.id").alias("u")).first()
    assert tuple(row) == (2, "u")
    assert values(spark, ["{'user.id':'u'}"], lambda c: C.properties_struct(c, ["user.id"]).getField("user.id")) == [None]


def test_assistant_text(spark):
    shapes = [
        {"content": "plain"}, {"content": {"text": "t"}}, {"content": {"text": {"value": "v"}}}, {"content": {}},
        {"content": {"text": {}}}, {"content": None}, {}, {"content": "{not json"}, {"content": 5},
    ]
    texts = [json.dumps(s) for s in shapes] + ["{bad", None]
    want = ["plain", "t", "v", "", "", "", "", "{not json", "5", "", ""]
    assert values(spark, texts, C.assistant_text) == want


def test_small_texts(spark):
    assert values(spark, ["RunStatus.COMPLETED", "x", None], C.strip_status) == ["COMPLETED", "x", ""]
    assert values(spark, ["abc", "abcd", None], lambda c: C.preview(c, 3)) == ["abc", "abc...", None]
    assert values(spark, ["True", "true", "false", None], C.is_success) == [True, True, False, False]
