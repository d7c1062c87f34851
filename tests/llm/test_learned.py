"""Quality and language classifiers, near duplicates, repeats, leaks and neighbours."""

from __future__ import annotations

import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spanloom.llm import classify, contamination, graph, jaccard, neighbours, suffixes
from spanloom.llm.queries import QUERIES

from . import brute
from .conftest import SMALL

MEDIUM = "/root/testdata/sf0.01"


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_quality_on_the_held_out_fold(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    rows = QUERIES["op1_quality"](spark, MEDIUM).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == fold(r.doc_id) for r in rows)
    test = [r for r in rows if r.held_out and r.doc_id in labels]
    assert len(rows) == 1000 and len(test) > 50
    assert np.mean([r.predicted == labels[r.doc_id] for r in test]) >= 0.97


def test_language_on_the_held_out_fold(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op5_language"](spark, MEDIUM).collect()
    test = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and np.mean([r.lang_pred == lang[r.doc_id] for r in test]) >= 0.97
    assert np.mean([r.rejected for r in rows]) < 0.02


def test_classifiers_on_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, 1), (None, 1, 1), (7, 1, 0), (9, 0, 0), (77, 1, 0)], "doc_id long, quality int, toxic int")
    scored = classify.score_quality(odd_docs, classify.fit_quality(odd_docs, labels)).collect()
    assert len(scored) == odd_docs.count() and all(0 <= r.score <= 1 for r in scored)
    assert {r.score for r in classify.score_quality(odd_docs, classify.fit_quality(odd_docs, labels.limit(0))).collect()} == {0.5}
    assert classify.score_quality(no_docs, None).collect() == []
    found = classify.identify_language(odd_docs, classify.fit_language(odd_docs))
    assert found.columns == [*odd_docs.columns, "lang_pred", "score", "rejected"]
    for r in found.collect():
        if not r.text or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        else:
            assert r.lang_pred in ("en", "de") and 0 <= r.score <= 1
    assert classify.identify_language(no_docs, classify.fit_language(no_docs)).collect() == []


def same_rows(df, expected):
    def order(rows):
        return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x or 0) for x in r[:3]) + r[3:])

    assert order(df.collect()) == order(expected)


def test_jaccard_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    same_rows(QUERIES["op8_jaccard"](spark, SMALL), brute.jaccard_components(docs, 4, 85))


def test_jaccard_on_groups_and_odd_rows(spark, odd_docs, no_docs, monkeypatch):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    shared = [rng.choice(words) for _ in range(60)]
    for g in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([8, 30, 120]))]
        for _ in range(8):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((100 + len(rows), " ".join(copy)))
        rows.append((100 + len(rows), " ".join(shared + base)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute.jaccard_components(rows, 5, 80)
    same_rows(jaccard.jaccard_classes(df), expected)
    # Long lists dealt to cells, and few hash minima in common, find the same links.
    monkeypatch.setattr(jaccard, "HOT_LIST", 2)
    monkeypatch.setattr(jaccard, "KEY_BINS", ())
    monkeypatch.setattr(jaccard, "ordering", lambda counts: np.ones(len(counts), np.uint8))
    monkeypatch.setattr(jaccard, "star_pairs", lambda classes, percent: classes.select(classes.rep.alias("a"), classes.rep.alias("b")).limit(0))
    same_rows(jaccard.jaccard_classes(df), expected)
    assert jaccard.jaccard_classes(no_docs).collect() == []


def test_one_of_each(spark, odd_docs):
    kept = jaccard.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in ids if x is not None) == [1, 4, 5, 6, 7, 9, 10, 11] and ids.count(None) == 2


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 180)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(70)] + [(500, 500)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for a, b in links if a != b for x in (a, b)}


def test_suffix_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    same_rows(QUERIES["op10_suffixes"](spark, SMALL), brute.remove_repeats(docs, 50))


def test_suffixes_on_odd_rows(spark, odd_docs, no_docs):
    rng = random.Random(11)
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    pieces = ["".join(rng.choice("ab é") for _ in range(rng.randrange(20, 90))) for _ in range(12)] + ["ab" * 40, "a" * 130, "abc" * 50]
    for i in range(80):
        rows.append((rng.choice([i, 50, None]) if i % 9 == 0 else 1000 - i, "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 9)))))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    same_rows(suffixes.digest(suffixes.remove_repeats(df)), brute.remove_repeats(rows, 50))
    assert suffixes.remove_repeats(no_docs).collect() == []


def test_suffixes_of_hot_anchors(spark, odd_docs):
    rng = random.Random(12)
    passage = "This licence line stands in very many documents and has other text around it. "
    texts = [" ".join(f"w{rng.randrange(9000)}" for _ in range(20)) + passage + " ".join(f"w{rng.randrange(9000)}" for _ in range(20)) for _ in range(400)]
    rows = list(enumerate(texts)) + [(r.doc_id, r.text) for r in odd_docs.collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = brute.remove_repeats(rows, 50)
    for hot in (1, 100):
        same_rows(suffixes.digest(suffixes.remove_repeats(df, hot=hot)), wanted)

    # No bucket gets much of what a hot anchor brings.
    table = pa.table({"doc_id": pa.array(range(400), pa.int64()), "addr": pa.array(range(400), pa.int64()), "addr2": pa.array([0] * 400, pa.int64()), "times": pa.array([1] * 400, pa.int64()), "text": texts})
    documents = pa.Table.from_batches(suffixes._post(suffixes.DOCS, np.zeros(400, np.int64), table))
    found = [suffixes.contexts(d, b, 50, 25)[0] for _, _, d, b in suffixes.text_slices(table.column("text"))]
    keys, counts = np.unique(suffixes._full_key(*suffixes._anchor_key(np.concatenate(found), 64)), return_counts=True)
    facts = [suffixes._rows(kind, np.zeros(1, int), [keys[counts > least].tobytes()]) for kind, least in ((suffixes.REPEATED, 1), (suffixes.HOT, 100))]
    sent = suffixes.batch_contexts(documents, pa.Table.from_batches(facts), 64, 50, 25).to_pylist()
    received = np.zeros(64)
    for r in sent:
        if r["kind"] == suffixes.STRINGS:
            received[r["dest"]] += len(r["data"])
        elif r["kind"] == suffixes.CONTEXTS:
            received[r["dest"]] += suffixes._unpack([r["data"]]).nbytes
    assert received.max() < 4 * received.mean()


def test_a_hot_anchor_is_one_entry_per_batch():
    texts = [f"{i:06d} " + "This licence line stands in very many documents and has other text around it. " + f"{i * 7919 % 99991:06d}" for i in range(3000)]
    table = pa.table({"doc_id": pa.array(range(3000), pa.int64()), "addr": pa.array(range(3000), pa.int64()), "addr2": pa.array([0] * 3000, pa.int64()), "times": pa.array([1] * 3000, pa.int64()), "text": texts})
    documents = pa.Table.from_batches(suffixes._post(suffixes.DOCS, np.full(3000, 5), table))
    sent = suffixes.batch_anchors(documents, pa.Table.from_batches([suffixes._rows(suffixes.COPIES, np.empty(0, int), [])]), 64, 50, 25, 100).to_pylist()
    entries, most = 0, 0
    for r in sent:
        given = np.frombuffer(r["data"], np.uint32)
        assert given[0] == 5
        keys = given[2 + given[1] :]
        assert len(np.unique(keys)) == len(keys)
        entries, most = entries + len(keys), max(most, int(given[2 : 2 + given[1]].max(initial=0)))
    held = [suffixes.contexts(d, b, 50, 25)[::3] for _, _, d, b in suffixes.text_slices(table.column("text"))]
    assert most == 101 and entries == len(np.unique(np.concatenate([suffixes._full_key(*suffixes._anchor_key(v, 64)) for v, _ in held])))


def test_rows_whose_first_hash_agrees_stay_apart():
    table = pa.table({"doc_id": pa.array([1, 2, 2], pa.int64()), "addr": pa.array([9, 9, 9], pa.int64()), "addr2": pa.array([1, 2, 2], pa.int64()), "times": pa.array([1, 1, 1], pa.int64()), "text": ["a", "b", "b"]})
    got = suffixes._documents([suffixes._pack(table)]).to_pydict()
    assert got["text"] == ["a", "b"] and got["times"] == [1, 2]


def test_suffix_sort():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    data[1000:1400] = data[200:600]
    at = np.concatenate([rng.permutation(1400)[:900], np.arange(1500, 2900)])
    segment = np.concatenate([np.zeros(900, int), np.ones(1400, int)])
    got = suffixes.Suffixes(data, 50).sort(at, segment)
    text = data.tobytes()
    assert [text[i : i + 50] for i in got[:900]] == sorted(text[i : i + 50] for i in at[:900])
    assert [text[i : i + 50] for i in got[900:]] == sorted(text[i : i + 50] for i in at[900:])


def smith_waterman(item, passage):
    best, above = 0.0, [0.0] * (len(passage) + 1)
    for x in item:
        row = [0.0]
        for j, y in enumerate(passage):
            step = contamination.MATCH if x == y else contamination.MISMATCH
            row.append(max(0.0, above[j] + step, above[j + 1] + contamination.GAP, row[j] + contamination.GAP))
        best, above = max(best, max(row)), row
    return best


def edited_copies(spark, seed, edit):
    """20 items with one copy each, edited and put into other words: leaks found, and leaks of an alignment of all pairs."""
    rng = random.Random(seed)
    items = [[f"w{rng.randrange(400)}" for _ in range(rng.choice([20, 39, 40]))] for _ in range(20)]
    docs = []
    for item in items:
        around = [f"w{rng.randrange(400)}" for _ in range(60)]
        docs.append(around[:30] + edit(rng, item) + around[30:])
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    rows = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(docs)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in contamination.find_leaks(rows, bench).collect()}
    scores = {(d, i): smith_waterman(x, y) / len(x) for d, y in enumerate(docs) for i, x in enumerate(items)}
    return got, {pair: score for pair, score in scores.items() if score >= contamination.THRESHOLD}


def test_leaks_of_edited_copies(spark):
    def substitute(rng, item):
        own = list(item)
        for k in range(len(item) // 5 if len(item) > 20 else 3):
            own[k * 5 + (2 if len(item) > 20 else 4)] = f"new{rng.randrange(99)}"
        return own

    got, wanted = edited_copies(spark, 1, substitute)
    assert len(wanted) == 20 and got == pytest.approx(wanted)


def test_leaks_across_insertions(spark):
    def insert(rng, item):
        half = len(item) // 2
        low, high = list(item[:half]), list(item[half:])
        low[3], high[-4] = "new", "other"
        return low + [f"in{k}" for k in range(len(item) * 5 // 8)] + high

    got, wanted = edited_copies(spark, 2, insert)
    assert len(wanted) == 20 and got == pytest.approx(wanted)


def test_items_with_a_common_stem():
    rng = random.Random(15)
    stem = " ".join(f"s{i}" for i in range(12))
    items = contamination.Items([{"item_id": str(i), "text": stem + " " + " ".join(f"w{rng.randrange(50000)}" for _ in range(20))} for i in range(8000)])
    clean = " ".join(f"w{rng.randrange(50000)}" for _ in range(2000)) + " " + stem + " " + " ".join(f"w{rng.randrange(50000)}" for _ in range(90))
    start = time.perf_counter()
    assert list(contamination.leaks(items, pa.array([clean]), 0.5)) == []
    assert time.perf_counter() - start < 2
    number = 4321
    own = items.words[items.begin[number] : items.begin[number] + 32]
    assert contamination._held(own[None, :], own[None, ::-1]).tolist() == [32]


@pytest.mark.parametrize("kind", ["string", "int"])
def test_items_of_any_id(spark, monkeypatch, kind):
    text = "one two three four five six seven eight nine ten"
    bench = spark.createDataFrame([("1", text), (None, text + " eleven")], "item_id string, text string").select(F.col("item_id").cast(kind), "text")
    docs = spark.createDataFrame([(i, f"before {text} after") for i in range(5)], "doc_id long, text string")
    monkeypatch.setattr(contamination, "HITS_AT_ONCE", 10)
    got = contamination.find_leaks(docs, bench)
    assert got.schema["item_id"].dataType == bench.schema["item_id"].dataType
    ones = {(i, x) for i in range(5) for x in ("1" if kind == "string" else 1, None)}
    assert {(r.doc_id, r.item_id) for r in got.collect()} == ones


def test_alignment_equals_the_plain_one():
    rng = np.random.default_rng(4)
    item, passage = rng.integers(2, 6, (50, 12)).astype(np.uint64), rng.integers(2, 6, (50, 30)).astype(np.uint64)
    score, _ = contamination.best_alignment(item, passage)
    assert score.tolist() == [smith_waterman(a, b) for a, b in zip(item.tolist(), passage.tolist(), strict=True)]


def test_leaks(spark, odd_docs, no_docs):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(900)]
    items = [(i, " ".join(rng.choice(words) for _ in range(30))) for i in range(20)] + [(20, None), (21, ""), (None, "an item of its own without a number here")]
    rows, planted = [], set()
    for i in range(200):
        text = [rng.choice(words) for _ in range(rng.randrange(1, 300))]
        if i % 4 == 0:
            passage = items[i % 20][1].split()
            for _ in range(6):
                at = rng.randrange(len(passage))
                passage[at : at + 1] = rng.choice([[], ["new"], [passage[at], "more"]])
            text[10:10] = [w.upper() + "," for w in passage]
            planted.add((i, i % 20))
        rows.append((i, " ".join(text)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = contamination.find_leaks(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == planted and all(0.5 <= r.score <= 1 for r in got)
    assert {r.doc_id for r in contamination.drop_leaks(docs, bench).collect()} == {i for i, _ in rows} - {i for i, _ in planted}
    # As much in slices of the benchmark.
    old, contamination.SLICE_BYTES = contamination.SLICE_BYTES, 500
    try:
        assert {(r.doc_id, r.item_id) for r in contamination.find_leaks(docs, bench).collect()} == planted
    finally:
        contamination.SLICE_BYTES = old
    assert contamination.find_leaks(odd_docs, bench).collect() == [] and contamination.find_leaks(no_docs, bench).collect() == []
    assert contamination.drop_leaks(odd_docs, bench.limit(0)).count() == odd_docs.count()
    assert contamination.drop_leaks(odd_docs, bench).columns == odd_docs.columns


def brute_neighbours(rows, every, k):
    out = {}
    for q, v in rows.items():
        if q % every == 0:
            scores = sorted(((-float(np.dot(v, x)), i) for i, x in rows.items() if i != q))
            out[q] = [i for _, i in scores[:k]]
    return out


def recall(got, wanted):
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(found) <= set(wanted)
    for rows in found.values():
        rows.sort()
        assert [x[0] for x in rows] == list(range(1, len(rows) + 1))
        assert rows == sorted(rows, key=lambda x: (-x[2], x[1]))
    return np.mean([len({x[1] for x in found.get(q, [])} & set(w)) / max(len(w), 1) for q, w in wanted.items()])


def test_neighbours_query(spark):
    rows = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()}
    assert recall(QUERIES["op6_neighbours"](spark, SMALL).collect(), brute_neighbours(rows, 20, 20)) >= 0.95


def test_long_vectors_do_not_widen_the_reach(spark, monkeypatch):
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((150, 32))
    rows = {i: centres[i % 150] + 0.3 * rng.standard_normal(32) for i in range(3000)}
    reached, measure = [], neighbours._reach
    monkeypatch.setattr(neighbours, "_reach", lambda *args: reached.append(measure(*args)) or reached[-1])
    for factor in (1, 100, 1e6):
        rows[7] = rows[7] * factor
        df = spark.createDataFrame([(i, v.tolist()) for i, v in rows.items()], "vec_id long, embedding array<double>")
        assert recall(neighbours.nearest(df).collect(), brute_neighbours(rows, 20, 20)) >= 0.95
    assert max(reached) <= 2 * reached[0]


def test_neighbours_in_pieces(spark, monkeypatch):
    rng = np.random.default_rng(10)
    rows = {i: rng.standard_normal(24) * rng.choice([0.01, 1, 3]) for i in range(1500)}
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows.items()], "vec_id long, embedding array<double>")
    wanted = brute_neighbours(rows, 20, 20)
    monkeypatch.setattr(neighbours, "_reach", lambda *args: 500)
    whole = recall(neighbours.nearest(df, curves=8).collect(), wanted)
    monkeypatch.setattr(neighbours, "PIECE", 64)
    monkeypatch.setattr(neighbours, "STRETCH", 200)
    # Reach in pieces is exact, not rounded up to a block.
    assert recall(neighbours.nearest(df, curves=8).collect(), wanted) >= min(whole - 0.02, 0.97)
    monkeypatch.setattr(neighbours, "_reach", lambda *args: 1500)
    assert recall(neighbours.nearest(df, curves=1).collect(), wanted) == 1


def test_neighbours_of_few_rows(spark):
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(i, rng.standard_normal(64).tolist()) for i in range(20)], "vec_id long, embedding array<double>")
    found = {(r.query_id, r.vec_id) for r in neighbours.nearest(df, 1, 20).collect()}
    assert found == {(q, x) for q in range(20) for x in range(20) if q != x}


def test_neighbours_on_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = {i: rng.standard_normal(8) * rng.uniform(0.1, 3) for i in range(150)}
    rows |= {i: np.arange(1.0, 9.0) for i in range(150, 260)}
    table = [(i, v.tolist(), "x") for i, v in rows.items()] + [(0, rows[0].tolist(), "x")]
    table += [(300, None, "x"), (320, [0.0] * 8, "x"), (340, [float("nan")] + [1.0] * 7, "x"), (360, [None] + [1.0] * 7, None), (380, [1.0], "x"), (None, [1.0] * 8, "x"), (400, [float("inf")] * 8, "x")]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>, h string")
    assert recall(neighbours.nearest(df, 20, 5).collect(), brute_neighbours(rows, 20, 5)) >= 0.95
    assert neighbours.nearest(df.limit(0)).collect() == []
    few = df.filter("vec_id in (0, 1, 2)")
    assert [r.rank for r in neighbours.nearest(few).orderBy("rank").collect()] == [1, 2]


def test_hilbert_curve_visits_neighbours():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    keys = neighbours.hilbert_keys(cells, 3)
    assert sorted(keys) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("texts", [["", "a", "a b a b c", "x" * 3000, "é ü"], [""], []])
def test_hashing_of_slices(texts):
    from spanloom.llm import hashing

    for limit in (1, 10, 1 << 20):
        got = []
        for _, _, data, bounds in hashing.text_slices(pa.array(texts, pa.string()), limit):
            starts, ends, firsts = hashing.words(data, bounds)
            found = [bytes(data[s:e]) for s, e in zip(starts, ends, strict=True)]
            got += [found[firsts[i] : firsts[i + 1]] for i in range(len(firsts) - 1)]
        assert got == [t.encode().split() for t in texts]


def test_three_hundred_languages(spark):
    """More classes than a vector has places; a label of few rows is learned too, and equal rows are drawn once."""
    rng = np.random.default_rng(0)
    rows = []
    for lang in range(300):
        words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 5)) for _ in range(12)]
        rows += [(lang * 100 + i, " ".join(rng.choice(words, 30)), f"l{lang:03d}") for i in range(14)]
    rows += [(9_000_001, "the same text", "hot")] * 5000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)
    assert classify.sample_by_class(docs, "lang", 600).filter("lang = 'hot'").count() <= 1
    fitted = classify.fit_language(docs, per_class=12)
    assert len(fitted.model.classes) >= 300 and fitted.model.head is not None
    found = classify.identify_language(docs.filter("lang <> 'hot'").withColumn("_lettered", F.lit(1)), fitted)
    right, n = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert n == 4200 and right > 0.9 * n and "_lettered" in found.columns
