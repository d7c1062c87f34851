"""The corpus pipeline, stage by stage, against plain versions of its decisions."""

from __future__ import annotations

import threading
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spanloom.llm import classify, common, contamination, hashing, jaccard
from spanloom.operators.staging import stage, stage_alone, stage_root

from . import brute
from .conftest import SMALL
from .test_native import check_shards

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    functions = dict(corpus_pipeline.STAGES)
    assert list(functions) == ["language_id", "near_duplicates", "decontamination", "mixing", "sharding"]

    known = stage(functions["language_id"](spark, docs, SMALL), "t1")
    assert known.columns == docs.columns and known.count() >= 0.98 * docs.count()

    unique = stage(functions["near_duplicates"](spark, known, SMALL), "t2")
    rows = [(r.doc_id, r.text) for r in known.collect()]
    assert {r.doc_id for r in unique.collect()} == {root for _, _, root in brute.jaccard_components(rows, 5, 80)}

    clean = stage(functions["decontamination"](spark, unique, SMALL), "t3")
    leaked = {r.doc_id for r in contamination.find_leaks(unique, spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in unique.collect()} - leaked

    mixed = stage(functions["mixing"](spark, clean, SMALL), "t4")
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in clean.collect()}
    words = [sum(len(brute.WORD.findall(r.text)) for r in df.collect()) for df in (clean, mixed)]
    assert abs(words[1] / words[0] - 1) < 0.25

    sharded = functions["sharding"](spark, mixed, SMALL).collect()
    check_shards(sharded, 16)
    assert sorted(r.doc_id for r in sharded) == sorted(r.doc_id for r in mixed.collect())


def test_run(spark):
    first = corpus_pipeline.run(spark, SMALL)
    assert {"shard", "slot"} <= set(first.columns) and first.count() > 0


def test_rows_go_back_in_portions(spark, monkeypatch):
    """Language ID and decontamination return a batch in portions of about a slice, with all rows as before."""
    few = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs = few.crossJoin(F.broadcast(spark.range(8).select())).coalesce(1)
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    fitted = classify.fit_language(few)
    returned = []

    def run_here(self, function, schema):
        rows = list(function(iter(self.toArrow().to_batches())))
        returned.append(rows)
        return spark.createDataFrame(pa.Table.from_batches(rows), schema)

    stages = (lambda: classify.identify_language(docs, fitted), lambda: contamination.drop_leaks(docs, bench))
    for build in stages:
        whole = sorted(tuple(r) for r in build().collect())
        with monkeypatch.context() as own:
            own.setattr(type(docs), "mapInArrow", run_here)
            assert sorted(tuple(r) for r in build().collect()) == whole
        sizes = [(b.num_rows, sum(len(t or "") for t in b.column("text").to_pylist())) for b in returned[-1]]
        assert len(sizes) > 2 and all(rows == 1 or size <= hashing.SLICE for rows, size in sizes)
    empty = pa.RecordBatch.from_pylist([], pa.schema([("text", pa.string())]))
    assert list(hashing.portions(empty)) == []


def staged_now(spark):
    return {p.name for p in Path(stage_root(spark).removeprefix("file:")).glob("*")}


def test_near_duplicates_keep_one_stage(spark, odd_docs):
    before = staged_now(spark)
    rows = jaccard.one_of_each(odd_docs)
    assert [name.rsplit("-", 1)[0] for name in staged_now(spark) - before] == ["components"]
    found = sorted((r.doc_id or 0, r.text or "") for r in rows.collect())
    assert len(found) == len(set(found)) and {i for i, _ in found} == {0, 1, 4, 5, 6, 7, 9, 10, 11}


def test_stages_of_other_threads_stay(spark):
    other = []

    def build():
        worker = threading.Thread(target=lambda: other.append(stage(spark.range(5), "of-another-thread")))
        worker.start()
        worker.join()
        return stage(spark.range(7), "on-the-way")

    assert stage_alone(spark, build, "result").count() == 7
    assert other[0].count() == 5 and not any(n.startswith("on-the-way") for n in staged_now(spark))


def test_only_rows_that_may_match_are_taken(spark):
    keys = spark.range(0, 40_000, 20).select(F.col("id").alias("k"))
    rows = spark.range(20_000).select(F.when(F.col("id") != 20, F.col("id")).alias("k"), F.lit("x").alias("_bits"))
    found = common.maybe_in(rows, "k", keys, "hit")
    assert found.columns == ["k", "_bits", "hit"] and found.count() == 20_000
    counts = {(r.none, r.own, r.hit): r.n for r in found.groupBy(F.col("k").isNull().alias("none"), (F.coalesce("k", F.lit(1)) % 20 == 0).alias("own"), "hit").agg(F.count("*").alias("n")).collect()}
    assert counts[False, True, True] == 999 and counts[True, False, False] == 1 and (False, True, False) not in counts
    assert counts.get((False, False, True), 0) < 100
    assert not common.maybe_in(rows, "k", keys.limit(0), "hit").filter("hit").count()


def test_driver_arrays_stay_small(monkeypatch):
    monkeypatch.setattr(hashing, "_powers", {"n": 0})
    hashing.prefix_hashes(np.zeros(1000, np.uint8))
    assert hashing._powers["n"] < 5000
    counts = np.random.default_rng(3).integers(0, 1 << 40, 200_000)
    assert (jaccard.excess(counts) == np.log2(np.maximum(counts - np.median(counts), 1)).astype(np.uint8)).all()
