"""Quality rules: measures, sketches and thresholds."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.llm import rules
from spanloom.llm.queries import QUERIES

from .brute import WORD
from .conftest import SMALL


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    base = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
    return *base, len(words) < 20 or 100 * len(covered) > 30 * len(words)


TEXTS = [
    None, "", " \t\r\n ", "a b c d e f g h", "a b c d e f g h " * 2, "x " * 40, "a b c d e f g h i a b c d e f g h j a b c d e f g h",
    "\n".join(["same line", "same line ", "same line", "", "", " "]), "漢字 𝒳 # * $ % & | < >\x0b\x0cend", "Ä" * 100_000, "w " * 30_000,
    " ".join(str(i) for i in range(40_000)), " ".join(str(i % 20_000) for i in range(40_000)), "<" * 200_000,
]


def test_measures(spark):
    df = spark.createDataFrame([(i, t, None, "s", "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string, source string, row string")
    got = {r.doc_id: r for r in rules.apply_rules(df).collect()}
    assert {i: (*[got[i][c] for c in rules.BASE], got[i].base_failed) for i in got} == {i: plain(t) for i, t in enumerate(TEXTS)}
    assert {got[i]["row"] for i in got} == {"x"}


def test_query_measures_every_document(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op11_rules"](spark, SMALL).collect()
    assert {r.doc_id: (*[r[c] for c in rules.BASE], r.base_failed) for r in rows} == {d: plain(t) for d, t in texts.items()}
    assert not any(r.kept and r.base_failed for r in rows)


@pytest.mark.parametrize("value", [0, 1, 63, 64, 65, 127, 128, 999_999, 10**12, 2**62])
def test_buckets_hold_their_values(spark, value):
    low, high = rules.edges(F.col("code"))
    row = spark.sql(f"select {value}L as v").withColumn("code", rules.bucket(F.col("v"))).select("code", low.alias("low"), high.alias("high")).first()
    assert row.low <= value <= row.high and row.high - row.low <= row.low / 32


def test_buckets_are_ordered(spark):
    codes = [r.c for r in spark.range(5000).select("id", rules.bucket(F.col("id")).alias("c")).orderBy("id").collect()]
    assert codes == sorted(codes) and set(codes) == set(range(max(codes) + 1))


def skewed(spark, n, seed=1):
    """Documents of two languages and many sources, one source with a third of all, with a known share of symbols."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else f"s{i % 40}"
        heavy = source == "hot"  # this source writes many symbols: its own threshold follows
        words = [("#" if rng.random() < (0.5 if heavy else 0.02) else "") + "word" + "abcdefghij"[j % 10] + str(rng.integers(1000)) for j in range(60)]
        rows.append((i, " ".join(words), "en" if i % 2 else None, source))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_sketches_merge_and_follow_their_group(spark):
    docs = skewed(spark, 1500)
    measures = rules.measure(docs).cache()
    sketch = rules.sketches(measures)
    whole = rules.merged(sketch).filter("level = 0").groupBy("rule").agg(F.sum("n").alias("n")).collect()
    assert {r["n"] for r in whole} == {1500}
    apart = rules.merged(rules.sketches(measures.filter("row.doc_id % 2 = 0")).unionByName(rules.sketches(measures.filter("row.doc_id % 2 = 1"))))
    assert sorted(map(tuple, apart.collect())) == sorted(map(tuple, rules.merged(sketch).collect()))
    limits = {r.group_key: r.limits["symbols"] for r in rules.thresholds(measures).collect()}
    hot = [v.high for k, v in limits.items() if "hot" in k]
    rest = {v.high for k, v in limits.items() if "hot" not in k}
    assert min(hot) > 2 * 10_000 and len(rest) == 2  # small sources share the sketch of their language
    assert rules.apply_rules(docs).filter("kept").count() > 1450


def test_quartiles_are_within_a_bucket(spark):
    measures = rules.measure(skewed(spark, 1500)).cache()
    values = sorted(r[0] for r in measures.select(rules.share(rules.RULES["word_length"])).collect())
    fence = rules.fences(rules.sketches(measures)).filter("level = 0 and rule = 'word_length'").first()
    q1, q3 = values[-(-1500 // 4) - 1], values[-(-3 * 1500 // 4) - 1]
    reach = rules.FENCE * max(q3 - q1, rules.RULES["word_length"].slack)
    assert abs(fence.low - (q1 - reach)) <= q3 / 4 and abs(fence.high - (q3 + reach)) <= q3 / 4


def test_junk_goes_and_clean_documents_stay(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = QUERIES["op11_rules"](spark, "/root/testdata/sf0.01").join(labels, "doc_id").collect()
    good, bad = [r for r in rows if r.quality == 1 and not r.base_failed], [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.98 * len(good) and sum(r.kept for r in bad) <= 0.05 * len(bad)


def test_odd_rows(spark, odd_docs, no_docs):
    out = rules.apply_rules(odd_docs)
    assert out.columns == odd_docs.columns + rules.OUTPUTS and out.count() == odd_docs.count()
    assert rules.apply_rules(no_docs).collect() == []
    clash = odd_docs.withColumnsRenamed({"shard": "kept", "n": "N_WORDS"})
    assert rules.apply_rules(clash).columns == [c for c in clash.columns if c not in ("kept", "N_WORDS")] + rules.OUTPUTS
