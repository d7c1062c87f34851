"""Vector codes against a plain version that compares every entry."""

from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from spanloom.llm import codes
from spanloom.llm.queries import QUERIES

from .conftest import SMALL

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=16, entries=64, rounds=2):
    """{vec_id: (code, error, label_error)} and the codebooks' digest, from rows (vec_id, vector, label) of one length."""
    kept = sorted((k, [math.floor(Fraction(float(x)) * 256) for x in v], g) for k, v, g in rows if v is not None and all(x is not None and math.isfinite(x) for x in v))
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            members = defaultdict(list)
            for _, v, _ in kept:
                members[nearest(cut(v, p), book)[1]].append(cut(v, p))
            for i, own in members.items():
                book[i] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = {k: [nearest(cut(v, p), books[p]) for p in range(parts)] for k, v, _ in kept}
    by_label = Counter()
    for k, _, g in kept:
        by_label[g] += sum(d for d, _ in found[k])
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return {k: ("".join(f"{i:02x}" for _, i in found[k]), sum(d for d, _ in found[k]), by_label[g]) for k, _, g in kept}, digest


def check(df, rows):
    wanted, digest = plain(rows)
    got = df.collect()
    assert {r.vec_id: (r.code, r.error, r.label_error) for r in got} == wanted and len(got) == len(wanted)
    assert {r.codebooks_sha256 for r in got} == {digest}


def test_query_against_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    check(QUERIES["op12_codes"](spark, SMALL), rows)


def test_odd_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(0, 0.2, (150, 32)).astype(np.float32)
    rows = [(i, [float(x) for x in v], None if i % 5 == 0 else i % 3) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[7][1], 7) for i in range(60)]  # equal vectors
    rows += [(2000, None, 1), (2001, [None] * 32, 1), (2002, [float("nan")] * 32, 1), (2003, [float("inf")] + [0.0] * 31, 1)]
    rows += [(2004, [-0.0] * 32, 1), (2005, [-1e-30] * 32, 1), (2006, [1e6] * 32, 9), (2007, [-123456.789] * 16 + [1e9] * 16, 9)]
    df = spark.createDataFrame(rows, SCHEMA)
    check(codes.compressed(df.repartition(5)), [tuple(r) for r in df.collect()])


def test_very_large_components_in_the_first_codebook(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 3, 16)], 1) for i in range(100)]
    rows[3] = (3, [1e5] * 15 + [3e6], 1)
    rows[80] = (80, [-4e6] * 16, 2)
    df = spark.createDataFrame(rows, SCHEMA)
    check(codes.compressed(df), [tuple(r) for r in df.collect()])
    huge = spark.createDataFrame([*rows, (200, [3e38] * 16, 3)], SCHEMA)
    got = {r.vec_id: r for r in codes.compressed(huge).collect()}
    assert len(got) == 101 and got[200].error <= codes.MAX_LONG and got[200].label_error <= codes.MAX_LONG


def test_few_rows_empty_tables_and_other_lengths(spark):
    few = [(2, [0.5] * 16, None), (1, [0.25] * 16, None), (2, [0.5] * 16, None)]
    got = sorted(tuple(r)[:4] for r in codes.compressed(spark.createDataFrame(few, SCHEMA)).select("vec_id", "code", "error", "label_error").collect())
    assert [g[0] for g in got] == [1, 2, 2] and all(g[2] == 0 for g in got)
    assert codes.compressed(spark.createDataFrame([], SCHEMA)).collect() == []
    assert codes.compressed(spark.createDataFrame([(1, None, 1)], SCHEMA)).collect() == []
    mixed = spark.createDataFrame([(1, [0.5] * 3, 1), (2, [0.5] * 20, 1), (3, [0.7] * 20, 1), (4, [], 1)], SCHEMA)
    assert sorted(r.vec_id for r in codes.compressed(mixed).collect()) == [2, 3]
    clash = spark.createDataFrame([(1, [0.5] * 16, 1, "x", 3.0)], SCHEMA + ", CODE string, n double")
    assert codes.encode(clash, codes.fit(clash)).columns == ["vec_id", "embedding", "label", "n", "code", "error"]


@pytest.mark.parametrize("bits", [1, 4, 9])
def test_cells_keep_every_nearest_entry(bits, monkeypatch):
    monkeypatch.setattr(codes, "MAX_CELLS", 500)  # the memory overflows in between
    rng = np.random.default_rng(bits)
    book = [tuple(int(x) for x in e) for e in rng.integers(-60, 60, (64, 4))]
    book[9] = book[3]  # a tie between entries: the lower number wins
    coder = codes.PartCoder(book, bits)
    for _ in range(3):
        values = rng.integers(-200, 200, (400, 4))
        best, dist = coder.nearest(values)
        every = ((values[:, None, :] - np.array(book)[None]) ** 2).sum(2)
        assert (best == every.argmin(axis=1)).all() and (dist == every.min(axis=1)).all()


def test_cells_are_evaluated_in_part_and_hashes_may_collide(monkeypatch):
    rng = np.random.default_rng(1)
    book = [tuple(int(x) for x in e) for e in rng.integers(-100, 100, (64, 4))]
    coder = codes.PartCoder(book)
    values = rng.integers(-100, 100, (3000, 4))
    wanted = coder.nearest(values)
    assert coder.count.mean() < 32
    known = len(coder.keys)
    coder.nearest(values)
    assert len(coder.keys) == known
    monkeypatch.setattr(codes.PartCoder, "_hash", lambda self, cells: (cells[:, 0] & 1).astype(np.uint64))
    again = codes.PartCoder(book).nearest(values)
    assert all((a == b).all() for a, b in zip(wanted, again, strict=True))
