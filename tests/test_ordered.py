"""Order-dependent operators against brute force, with hot keys, ties and copies cut over chunks."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from spanloom.operators.ordered import CHUNK, asof_backward, next_value, order_chunks, row_numbers, running_last

CHUNKS = 7


def _rows(seed: int, n: int = 400):
    """(key, at, value, row): one key with over a third of the rows, many equal times, gaps."""
    rng = random.Random(seed)
    return [
        (rng.choice(["hot", "hot", "hot", "a", "b", "c"]), rng.choice([1, 2, 3, 50, 50, 90]) + rng.randint(0, 3),
         rng.choice([None, None, i]), i)
        for i in range(n)
    ]


@pytest.fixture(scope="module", params=[1, 2])
def data(request, spark):
    rows = _rows(request.param)
    df = spark.createDataFrame(rows, "k string, at int, v int, row int")
    return rows, order_chunks(df, ["k"], ["at", "row"], CHUNKS)


def _by_key(rows):
    keys = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1], r[3])):
        keys.setdefault(r[0], []).append(r)
    return keys


def test_hot_key_is_cut(data):
    rows, chunked = data
    per_chunk = {r[CHUNK]: r["count"] for r in chunked.filter("k = 'hot'").groupBy(CHUNK).count().collect()}
    assert len(per_chunk) > 2
    assert max(per_chunk.values()) < len(rows) / 3


def test_exact_copies_are_cut(spark):
    df = spark.range(1000).select(F.lit("k").alias("k"), F.lit(1).alias("at"), F.col("id").alias("row"))
    chunked = order_chunks(df, ["k"], ["at", "row"], CHUNKS)
    assert chunked.groupBy(CHUNK).count().agg(F.max("count")).first()[0] < 400
    numbered = row_numbers(chunked, ["k"], ["at", "row"], "n")
    assert sorted(r.n for r in numbered.collect()) == list(range(1, 1001))


def test_running_last(data):
    rows, chunked = data
    want = {}
    for group in _by_key(rows).values():
        last = None
        for r in group:
            last = r[2] if r[2] is not None else last
            want[r[3]] = last
    got = running_last(chunked, ["k"], ["at", "row"], F.col("v"), "last")
    assert {r.row: r.last for r in got.collect()} == want


def test_running_last_carries_over_chunks_without_a_value(spark):
    rows = [("k", i, 7 if i == 0 else None, i) for i in range(300)]
    chunked = order_chunks(spark.createDataFrame(rows, "k string, at int, v int, row int"), ["k"], ["at", "row"], CHUNKS)
    got = running_last(chunked, ["k"], ["at", "row"], F.col("v"), "last")
    assert {r.last for r in got.collect()} == {7}


def test_next_value(data):
    rows, chunked = data
    want = {}
    for group in _by_key(rows).values():
        for r, following in zip(group, [*group[1:], None]):
            want[r[3]] = following[1] if following else None
    got = next_value(chunked, ["k"], ["at", "row"], F.col("at"), "next")
    assert {r.row: r.next for r in got.collect()} == want


def test_row_numbers(data):
    rows, chunked = data
    want = {r[3]: i for group in _by_key(rows).values() for i, r in enumerate(group, 1)}
    got = row_numbers(chunked, ["k"], ["at", "row"], "n")
    assert {r.row: r.n for r in got.collect()} == want


@pytest.mark.parametrize("by", [["k"], []])
@pytest.mark.parametrize("seed", [3, 4])
def test_asof(spark, by, seed):
    left, right = _rows(seed, 300), [(k, at, None, i + 10_000) for k, at, _, i in _rows(seed + 10, 120)]
    schema = "k string, at int, v int, row int"
    lefts, rights = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    got = asof_backward(lefts, rights, by, "at", ["row"], ["row"], "match", CHUNKS)
    want = {}
    for k, at, _, i in left:
        found = [(r[1], r[3]) for r in right if r[1] <= at and (not by or r[0] == k)]
        want[i] = max(found)[1] if found else None
    result = got.select("row", F.col("match.row").alias("found")).collect()
    assert len(result) == len(left)
    assert {r.row: r.found for r in result} == want
