"""Approximate nearest neighbours by shifted Hilbert curves.

Vectors are projected by seeded random rotations, one per curve, shifted at random, and put on a
Hilbert curve. Each curve's order is cut by range in Spark; queries look at the candidates within
reach on either side. Orders are cut into pieces of a fixed size, and a piece meets the queries of a
stretch of fixed length at a time, so a task's group does not grow with the reach. What the curves find is merged by approximate
scores of 8-bit codes and reranked exactly on the original vectors.

The reach is set by measurement: for a few sample queries the exact neighbours are found
by one pass over all vectors, and the reach is made long enough that the wanted share of them
lies within reach on some curve. Equal vectors are one entry of the index, so a vector that occurs
very often is no hot spot; an entry stands for its smallest ids, as ties go to them.

For inner products of vectors of unequal length, candidates get one more coordinate that makes all
of them equally long, and queries get 0 there: the nearest is then the largest inner product. So
that a few long vectors do not press all others together, candidates are put in bands by length, each
band half as long as the one before, the last with all the rest; each has its own scale and curves.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..operators.lookup import lookup
from ..operators.ordered import order_chunks, row_numbers
from ..operators.staging import stage
from .common import parallelism

CURVES = 32
DIMS = 12
BITS = 5
SAMPLE_QUERIES = 96
RECALL = 0.96
SPARE = 16
BANDS = 8
# Candidates of a piece, and places of the order whose queries meet a piece together.
PIECE = 4096
STRETCH = 8 * PIECE


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells`` (whole numbers under ``2 ** bits``)."""
    x = cells.T.astype(np.int64).copy()
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        for i in range(len(x)):
            swap = np.where(x[i] & q, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(x[i] & q, q - 1, swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        turn ^= np.where(x[-1] & q, q - 1, 0)
    x ^= turn
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for row in x:
            key = (key << 1) | ((row >> b) & 1)
    return key


def curve(size: int, number: int, seed: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(projection, shift) of one curve."""
    rng = np.random.default_rng([seed, number])
    rotation = np.linalg.qr(rng.standard_normal((size, size)))[0][:, : min(dims, size)]
    return rotation, rng.random(rotation.shape[1])


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1) if len(column) else np.empty((0, 0))


def usable(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """(``vec_id``, ``v``) of rows that take part: finite, not zero, of the commonest length, with an id; of several
    different vectors under one id the smallest."""
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.exists("v", lambda x: x != 0))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.filter(F.coalesce(finite, F.lit(False)))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("v") == (common.n if common else 0)).groupBy("vec_id").agg(F.min("v").alias("v"))


def _exact_sample(queries: dict[int, np.ndarray], vectors: DataFrame, k: int) -> dict[int, list[int]]:
    """Exact neighbours (entries of the index) of a few queries, by one pass with a running best per task."""
    ids = np.array(list(queries))
    q = np.stack([queries[i] for i in ids]) if len(ids) else np.empty((0, 0))

    def best(batches):
        top_score, top_id = np.full((len(ids), 0), 0.0), np.full((len(ids), 0), 0)
        for batch in batches:
            own = batch.column("vec_id").to_numpy()
            score = q @ _matrix(batch.column("v")).T
            score[ids[:, None] == own[None, :]] = -np.inf
            top_score = np.concatenate([top_score, score], axis=1)
            top_id = np.concatenate([top_id, np.broadcast_to(own, score.shape)], axis=1)
            keep = np.argsort(-top_score, axis=1, kind="stable")[:, :k]
            top_score, top_id = np.take_along_axis(top_score, keep, 1), np.take_along_axis(top_id, keep, 1)
        n = top_id.shape[1]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, n)), pa.array(top_id.ravel()), pa.array(top_score.ravel())], ["q", "x", "s"])

    found = vectors.select("vec_id", "v").mapInArrow(best, "q long, x long, s double").filter(F.col("s") > float("-inf"))
    ranked = found.withColumn("_n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("s"), "x"))).filter(F.col("_n") <= k)
    out: dict[int, list[int]] = {}
    for row in ranked.collect():
        out.setdefault(row["q"], []).append(row["x"])
    return out


def nearest(df: DataFrame, every: int = 20, k: int = 20, curves: int = CURVES, seed: int = 0, recall: float = RECALL, vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` nearest found of each query, largest inner product first.

    Queries are the rows whose ``vec_id`` is divisible by ``every``; candidates all rows but the
    query's own. Ties go to the smaller id. NULL, zero and non-finite vectors and vectors of another
    length than most take no part, nor do rows without id; repeated rows count once. With fewer than
    ``k`` candidates in reach all that were found are returned. An empty table gives no rows.
    """
    spark = df.sparkSession
    rows = stage(usable(df, vector).withColumn("h", F.concat_ws(":", F.xxhash64("v"), F.xxhash64(F.lit(seed), "v", F.lit(1)))), "vectors")
    first = rows.first()
    if first is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size = len(first["v"])
    # Places of the ids among equal vectors, in chunks of any group's rows.
    placed = stage(row_numbers(order_chunks(rows.select("h", "vec_id"), ["h"], ["vec_id"]), ["h"], ["vec_id"], "place").select("h", "vec_id", "place"), "places")
    asked = placed.groupBy("h").agg(F.max(F.col("vec_id") % every == 0).alias("asked"), F.min("vec_id").alias("rep"))
    entries = stage(lookup(rows.join(asked.select(F.col("rep").alias("vec_id"), "asked"), "vec_id"), asked.select("h", "rep"), ["h"], "inner").select("vec_id", "asked", "v"), "entries")
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    longest, many = entries.agg(F.max(length), F.count(F.lit(1))).first()

    own_band = F.least(F.floor(F.log2(F.lit(longest) / length)), F.lit(BANDS - 1)).cast("int")
    # At most BANDS rows.
    scales = {r["band"]: r["scale"] for r in entries.groupBy(own_band.alias("band")).agg(F.max(length).alias("scale")).collect()}

    def lay(batches):
        """Every curve's entries: candidates with their key and code, queries likewise."""
        for batch in batches:
            x = _matrix(batch.column("v")) / longest
            ids, is_query = batch.column("vec_id").to_numpy(), batch.column("asked").to_numpy(zero_copy_only=False).astype(bool)
            bands = batch.column("band").to_numpy()
            norm = np.sqrt((x * x).sum(axis=1))[:, None]
            step = np.abs(x).max(axis=1) / 127
            codes = [c.tobytes() for c in np.rint(x / step[:, None]).astype(np.int8)]
            query = np.hstack([x / norm, 0 * norm])[is_query]
            asking = np.flatnonzero(is_query)
            for band, scale in scales.items():
                own = np.flatnonzero(bands == band)
                y = x[own] * (longest / scale)
                candidate = np.hstack([y, np.sqrt(np.maximum(1 - (y * y).sum(axis=1), 0))[:, None]])
                for role, data, which in ((0, candidate, own), (1, query, asking)):
                    for number in range(curves if len(data) else 0):
                        projection, shift = curve(size + 1, number, seed, DIMS)
                        # Projections of a rotated unit vector have a spread of 1 / sqrt(size).
                        place = (data @ projection * math.sqrt(size + 1) / 8 + 0.5) * 0.5 + shift * 0.5
                        cells = np.clip((place * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)
                        key = hilbert_keys(cells, BITS)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(key), band * curves + number), pa.int32()), pa.array(key), pa.array(ids[which]), pa.array(np.full(len(key), role), pa.int32()),
                             pa.array(step[which]), pa.array([codes[i] for i in which], pa.binary())],
                            ["curve", "key", "vec_id", "role", "step", "code"],
                        )

    laid = entries.withColumn("band", own_band).mapInArrow(lay, "curve int, key long, vec_id long, role int, step double, code binary")
    order = ["key", "vec_id", "role"]
    chunked = order_chunks(laid, ["curve"], order)
    # Rank among the candidates of the curve; queries take the rank of the candidates before them.
    inside = Window.partitionBy("_chunk", "curve").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = chunked.groupBy("_chunk", "curve").agg(F.sum(1 - F.col("role")).alias("_n"))
    before = Window.partitionBy("curve").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_chunk", "curve", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    ranked = chunked.withColumn("_inner", F.sum(1 - F.col("role")).over(inside)).join(F.broadcast(offsets), ["_chunk", "curve"])
    ranked = stage(ranked.withColumn("rank", F.col("_offset") + F.col("_inner")).select("curve", "rank", "vec_id", "role", "step", "code"), "curves")

    # Where there are hardly more entries than are wanted, each is in reach of all.
    reach = many if many <= 4 * (k + SPARE) else _reach(entries, ranked, k, recall)
    piece = min(reach, PIECE)

    def at(place, width):
        return F.floor(place / width).cast("long")

    rank, own_piece = F.col("rank"), at(F.col("rank"), piece)
    # A piece and a stretch meet if a query of the stretch has a candidate of the piece within reach.
    in_reach = F.sequence(F.greatest(at(rank - reach, piece), F.lit(0).cast("long")), at(rank + reach, piece))
    asked_from = F.sequence(F.greatest(at(own_piece * piece - reach, STRETCH), F.lit(0).cast("long")), at((own_piece + 1) * piece - 1 + reach, STRETCH))
    meetings = F.when(F.col("role") == 1, F.transform(in_reach, lambda p: F.struct(p.alias("piece"), at(rank, STRETCH).alias("stretch")))).otherwise(
        F.transform(asked_from, lambda q: F.struct(own_piece.alias("piece"), q.alias("stretch"))))
    dealt = ranked.withColumn("_met", F.explode(meetings)).select("*", "_met.piece", "_met.stretch").drop("_met")
    wanted = k + SPARE

    def search(table: pa.Table) -> pa.Table:
        role = table.column("role").to_numpy()
        code = np.frombuffer(b"".join(table.column("code").to_pylist()), np.int8).reshape(len(role), size).astype(np.float32)
        code *= table.column("step").to_numpy()[:, None].astype(np.float32)
        ids = table.column("vec_id").to_numpy()
        q, c = np.flatnonzero(role == 1), np.flatnonzero(role == 0)
        out_q, out_x, out_s = [], [], []
        for low in range(0, len(q) if len(c) else 0, 512):
            mine = q[low : low + 512]
            score = code[mine] @ code[c].T
            score[ids[mine][:, None] == ids[c][None, :]] = -np.inf
            keep = np.argpartition(-score, wanted - 1, axis=1)[:, :wanted] if len(c) > wanted else np.broadcast_to(np.arange(len(c)), score.shape)
            out_q.append(np.repeat(ids[mine], keep.shape[1]))
            out_x.append(ids[c][keep].ravel())
            out_s.append(np.take_along_axis(score, keep, 1).ravel())
        columns = [np.concatenate(x) if x else np.empty(0, kind) for x, kind in ((out_q, np.int64), (out_x, np.int64), (out_s, np.float32))]
        real = np.isfinite(columns[2])
        by = np.flatnonzero(real)
        first = np.flatnonzero(np.diff(columns[0][by], prepend=-1 if not len(by) else columns[0][by][0] - 1))
        bounds = np.append(first, len(by))
        return pa.table({
            "query_id": pa.array(columns[0][by][first], pa.int64()),
            "ids": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(columns[1][by], pa.int64())),
            "scores": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(columns[2][by], pa.float32())),
        })

    found = dealt.groupBy("curve", "piece", "stretch").applyInArrow(search, "query_id long, ids array<long>, scores array<float>")

    def merge(batches):
        """The best entries of each query; lists come in order of the query, so one query is held at a time."""
        now, own = None, {}

        def best(n):
            return dict(sorted(own.items(), key=lambda x: (-x[1], x[0]))[:n])

        def answer():
            chosen = best(wanted)
            return pa.RecordBatch.from_arrays([pa.array([now] * len(chosen), pa.int64()), pa.array(list(chosen), pa.int64())], ["query_id", "entry"])

        for batch in batches:
            done = []
            for q, ids, scores in zip(*(batch.column(c).to_pylist() for c in ("query_id", "ids", "scores")), strict=True):
                if q != now:
                    if own:
                        done.append(answer())
                    now, own = q, {}
                own.update(zip(ids, scores, strict=True))
                if len(own) > 8 * wanted:
                    own = best(wanted)
            if done:
                yield from pa.Table.from_batches(done).combine_chunks().to_batches()
        if own:
            yield answer()

    near = found.repartition(parallelism(spark), "query_id").sortWithinPartitions("query_id").mapInArrow(merge, "query_id long, entry long")
    # A query's equals are as near as it is to itself.
    near = near.unionByName(entries.filter("asked").select(F.col("vec_id").alias("query_id"), F.col("vec_id").alias("entry")))
    return _rerank(near, entries, placed, asked, every, k)


def _reach(entries: DataFrame, ranked: DataFrame, k: int, recall: float) -> int:
    """Distance in the order at which ``recall`` of the exact neighbours of the sample queries is in reach on some curve."""
    spark = entries.sparkSession
    sample = entries.filter("asked").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_QUERIES).collect()
    exact = _exact_sample({r["vec_id"]: np.array(r["v"]) for r in sample}, entries, k)
    pairs = [(q, x) for q, xs in exact.items() for x in xs]
    if not pairs:
        return 1
    # At most SAMPLE_QUERIES * k pairs.
    table = spark.createDataFrame(pairs, "q long, x long")
    wanted = F.broadcast(table)
    of_query = ranked.filter("role = 1").join(F.broadcast(table.select(F.col("q").alias("vec_id")).distinct()), "vec_id").select("curve", F.col("vec_id").alias("q"), F.col("rank").alias("_rq"))
    of_other = ranked.filter("role = 0").join(wanted, F.col("vec_id") == F.col("x")).select("curve", "q", "x", F.col("rank").alias("_rx"))
    gaps = of_other.join(F.broadcast(of_query), ["curve", "q"]).groupBy("q", "x").agg(F.min(F.abs(F.col("_rq") - F.col("_rx"))).alias("gap"))
    gap = sorted(r["gap"] for r in gaps.collect())
    return int(gap[min(len(gap) - 1, int(len(gap) * recall))]) + 1


def _rerank(near: DataFrame, entries: DataFrame, placed: DataFrame, asked: DataFrame, every: int, k: int) -> DataFrame:
    """Exact scores of the pairs of entries, then the ``k`` nearest rows of each query row."""
    vectors = entries.select("vec_id", "v")
    pairs = lookup(near, vectors.select(F.col("vec_id").alias("entry"), F.col("v").alias("_x")), ["entry"], "inner")
    pairs = lookup(pairs, vectors.select(F.col("vec_id").alias("query_id"), F.col("v").alias("_q")), ["query_id"], "inner")
    score = F.aggregate(F.zip_with("_q", "_x", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    scored = pairs.select("query_id", "entry", score.alias("score"))
    # Of equal vectors only the k + 1 smallest ids can be among the k nearest of another row.
    members = lookup(placed.filter(F.col("place") <= k + 1), asked.select("h", F.col("rep").alias("entry")), ["h"], "inner")
    ids = members.groupBy("entry").agg(F.array_sort(F.collect_list("vec_id")).alias("_ids"))
    expanded = lookup(scored, ids, ["entry"], "inner").select("query_id", "score", F.explode("_ids").alias("vec_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    lists = expanded.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k + 1)
    lists = lists.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("_n", "vec_id", "score"))).alias("_list"))
    queries = lookup(placed.filter(F.col("vec_id") % every == 0), asked.select("h", F.col("rep").alias("_entry")), ["h"], "inner").select(F.col("vec_id").alias("_query"), "_entry")
    own = lookup(queries, lists.select(F.col("query_id").alias("_entry"), "_list"), ["_entry"], "inner")
    others = F.slice(F.filter("_list", lambda x: x["vec_id"] != F.col("_query")), 1, k)
    return own.select("_query", F.posexplode(others).alias("_at", "_one")).select(
        F.col("_query").alias("query_id"), (F.col("_at") + 1).cast("int").alias("rank"), F.col("_one.vec_id").alias("vec_id"), F.col("_one.score").alias("score")
    )
