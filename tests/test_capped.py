"""Numbering with limits against a step-by-step count."""

from __future__ import annotations

import random

import pytest

from spanloom.operators import capped
from spanloom.operators.capped import UNLIMITED, Removed, capped_numbers, counted_from, thresholds
from spanloom.operators.ordered import CHUNK, order_chunks


def test_taken_numbers_against_a_list():
    rng, removed, left = random.Random(1), Removed(), list(range(9000))
    for _ in range(4000):
        m = int(rng.random() ** 2 * 300)
        assert removed.take(m) == left.pop(m)
    assert removed.sorted() == sorted(set(range(9000)) - set(left))


@pytest.mark.parametrize("seed", range(30))
def test_thresholds_compose_the_steps(seed, monkeypatch):
    monkeypatch.setattr(capped, "BLOCK", 4)
    rng = random.Random(seed)
    limits = [rng.choice([UNLIMITED, rng.randrange(1 + 2 * seed), rng.randrange(12)]) for _ in range(60)]
    for largest in (0, 5, 200):
        able, found = thresholds(limits, largest)
        assert found == sorted(found)
        for start in range(largest + 1):
            want = start + sum(1 for n in counted_from(start, limits) if n)
            assert start + able - sum(t <= start for t in found) == want


def table(spark, seed, hot, n=400):
    rng = random.Random(seed)
    rows = [("hot" if rng.random() < hot else f"k{rng.randrange(9)}", i, rng.choice([None, rng.randrange(60)]), f"text {i}") for i in range(n)]
    return rows, spark.createDataFrame(rows, "k string, at long, lim long, text string")


@pytest.mark.parametrize("seed,hot,chunks", [(1, 0.9, 6), (2, 0.3, 9), (3, 0.0, 1)])
def test_numbers(spark, seed, hot, chunks):
    rows, df = table(spark, seed, hot)
    chunked = order_chunks(df, ["k"], ["at"], chunks)
    wanted = {}
    for key in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == key]
        numbers = counted_from(0, [UNLIMITED if r[2] is None else r[2] for r in own])
        wanted |= {r[3]: n for r, n in zip(own, numbers, strict=True) if n}
    got = capped_numbers(chunked, "k", ["at"], "lim", "nth")
    assert got.columns == ["k", "at", "lim", "text", "nth"]
    assert {r.text: r.nth for r in got.collect()} == wanted
    if chunks > 1:
        assert chunked.filter("k = 'hot'").select(CHUNK).distinct().count() > 2


def test_jobs_do_not_grow_with_the_messages(spark):
    """As many Spark jobs for a key with 10,000 limited rows as for one with 10."""
    tracker, counts = spark.sparkContext.statusTracker(), []
    for n in (10, 10_000):
        df = spark.range(n).selectExpr("'k' as k", "id as at", "id % 7 * (id div 9) as lim")
        chunked = order_chunks(df, ["k"], ["at"], 4)
        group = f"capped-{n}"
        spark.sparkContext.setJobGroup(group, group)
        numbers = [r.nth for r in capped_numbers(chunked, "k", ["at"], "lim", "nth").orderBy("at").collect()]
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert numbers == list(range(1, len(numbers) + 1)) and (n == 10 or len(numbers) > 1000)
        counts.append(len(tracker.getJobIdsForGroup(group)))
    assert 0 < counts[1] <= counts[0] + 1


def test_times_in_any_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.range(6).selectExpr("'k' as k", "timestamp_seconds(id) as at", "2L as lim")
        got = capped_numbers(order_chunks(df, ["k"], ["at"], 2), "k", ["at"], "lim", "nth")
        assert sorted((r.s, r.nth) for r in got.selectExpr("unix_seconds(at) as s", "nth").collect()) == [(0, 1), (1, 2)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_no_rows(spark):
    empty = spark.createDataFrame([], "k string, at long, lim long")
    assert capped_numbers(order_chunks(empty, ["k"], ["at"], 2), "k", ["at"], "lim", "nth").collect() == []
