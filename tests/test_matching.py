"""Greedy matching of events and ranked windows against the sequential rule."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pytest

from spanloom.operators.matching import NEVER, first_open, greedy_matches, sweep

WINDOWS, POINTS = "id string, rank long, start long, end long", "seq long"


def replay(windows, events):
    """Events in order, each taking the open window of lowest rank."""
    free, taken = {w[0]: w for w in windows}, {}
    for p in sorted(events):
        inside = [(r, i) for i, r, s, e in free.values() if s < p < e]
        if inside:
            i = min(inside)[1]
            taken[i] = p
            del free[i]
    return taken


def line(seed, length, threads, share, endless):
    """Windows that follow each other per thread, as runs do, and events in between."""
    rng = random.Random(seed)
    windows, events, last = [], [], {}
    for position in range(length):
        if rng.random() < share:
            events.append(position)
            continue
        thread = int(threads * rng.random() ** 2) if endless else rng.randrange(threads)
        if thread in last:
            windows.append((*last.pop(thread), position))
        if rng.random() < 0.9:
            last[thread] = (f"w{position}", thread, position)
    windows += [(*w, NEVER) for w in last.values()]
    return windows, events


def run(spark, windows, events, chunk_rows):
    found = greedy_matches(spark.createDataFrame(windows, WINDOWS).repartition(3), spark.createDataFrame([(e,) for e in events], POINTS), chunk_rows)
    return {r.id: r.seq for r in found.collect()}


@pytest.mark.parametrize("seed,threads,share,chunk_rows", [(1, 5, 0.5, 16), (2, 40, 0.3, 10), (3, 60, 0.6, 25), (4, 1, 0.5, 7), (5, 150, 0.45, 1 << 20)])
def test_equals_the_sequential_rule(spark, seed, threads, share, chunk_rows):
    windows, events = line(seed, 160, threads, share, seed % 2 == 0)
    assert run(spark, windows, events, chunk_rows) == replay(windows, events)


def test_many_endless_windows_meet_few_events(spark):
    """Nearly all windows pass nearly all chunks: no chunk sweeps more of them than can win, and few rounds are needed."""
    windows = [(f"w{i}", (i * 37) % 101, i, NEVER if i % 10 else 150) for i in range(101)]
    events = [p for p in range(101, 200) if p % 3]
    assert run(spark, windows, events, 10) == replay(windows, events)


def test_edges(spark):
    assert run(spark, [], [1, 2], 4) == {} and run(spark, [("a", 1, 0, NEVER)], [], 4) == {}
    # a window does not hold its ends; the first rank wins, the other waits
    assert run(spark, [("a", 1, 2, 9), ("b", 0, 5, NEVER)], [2, 9, 30], 4) == {"b": 9}
    assert run(spark, [("a", 1, 0, 12), ("b", 0, 1, 12)], [3, 11, 13], 4) == {"b": 3, "a": 11}


@pytest.mark.parametrize("chunk_rows", [1, 8, 1 << 20])
def test_first_open(spark, chunk_rows):
    windows, points = line(9, 120, 30, 0.4, True)
    found = first_open(spark.createDataFrame(windows, WINDOWS), spark.createDataFrame([(p,) for p in points], POINTS), chunk_rows)
    wanted = {p: min(((r, i) for i, r, s, e in windows if s < p < e), default=(0, None))[1] for p in points}
    assert {r.seq: r.id for r in found.collect()} == {p: i for p, i in wanted.items() if i}
    assert first_open(spark.createDataFrame(windows, WINDOWS), spark.createDataFrame([], POINTS), chunk_rows).collect() == []


def test_a_chunk_holds_few_bytes_a_window():
    """All windows open at once: the sweep's own memory stays under 130 bytes a window (167 with tuples in the heap)."""
    n = 100_000
    starts = np.arange(n)
    ends, ranks, events = np.full(n, NEVER), starts * 7919 % n, np.arange(n, n + 1000)
    tracemalloc.start()
    chosen, taken = sweep(starts, ends, ranks, events, True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ranks[chosen].tolist() == list(range(1000)) and (taken >= 0).sum() == 1000
    assert peak < 130 * n
