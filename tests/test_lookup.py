from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from spanloom.operators.lookup import lookup
from spanloom.operators.staging import stage

SKEW = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture
def small_skew_limits(spark):
    before = {k: spark.conf.get(k) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_hot_key_of_an_aggregate_lookup_is_split(spark, small_skew_limits):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
    facts = stage(
        spark.range(0, 300_000, 1, 16).select(key.alias("k"), F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("pad")),
        "facts",
    )
    top = facts.groupBy("k").agg(F.max("v").alias("top"))
    joined = lookup(facts, top, ["k"]).groupBy("top").agg(F.count("pad").alias("n"))
    counts = {r.top: r.n for r in joined.collect()}
    assert sum(counts.values()) == 300_000 and counts[299_997] == 100_000
    assert "SortMergeJoin(skew=true)" in joined._jdf.queryExecution().executedPlan().toString()


def test_kinds_of_lookup(spark):
    facts = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    dim = spark.createDataFrame([("a", "A"), (None, "N")], "k string, name string")
    names = lambda df: {r.v: r.name for r in df.collect()}
    assert names(lookup(facts, dim, ["k"])) == {1: "A", 2: None, 3: None}
    assert names(lookup(facts, dim, ["k"], "inner")) == {1: "A"}
    assert names(lookup(facts, dim, ["k"], null_safe=True)) == {1: "A", 2: None, 3: "N"}
