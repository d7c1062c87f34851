"""Events that each take the first-ranked open window, in order, without a single ordered task.

Windows and events stand on one line of whole-number positions. Events go in order of position; each
takes, of the windows that it lies in and that no earlier event took, the one of lowest rank. Ranks of
windows that overlap differ. The sequential rule is the one stable matching in which events want low
ranks and windows want early events, so it can be found by proposals, in any order:

The line is cut into chunks of equal length. A window bids in the chunk of its start; a chunk sweeps
the bids it holds and the new ones, in position order with a heap, and keeps one bid per event.
Bids it does not keep go on to the next chunk, within the window, that would take their rank: one that has
an event without a bid or one held by a higher rank. What a chunk holds only gets better, so a
bid never has to come back. Only chunks with new bids work in a round, all of them side by side; rounds
end when no bid moves, after at most as many rounds as there are chunks.

A task holds one chunk: its events, the windows that begin or end in it, and, of those that
span it, no more than can win.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .ordered import order_chunks, running_sum
from .staging import stage, stage_path

CHUNK_ROWS = 1 << 20
NEVER = (1 << 63) - 1  # end of a window that stays open; also the rank limit of a chunk that takes any bid
NOTHING = -1  # rank limit of a chunk without events

BID = "id string, rank long, start long, end long"


def _chunk_of(position: Column, chunk_rows: int) -> Column:
    return F.call_function("div", position, F.lit(chunk_rows).cast("long"))


def sweep(starts: np.ndarray, ends: np.ndarray, ranks: np.ndarray, events: np.ndarray, consume: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``events`` (ascending) the number of the window it takes, or -1; and each window's event, or -1.

    Without ``consume`` a window may be taken again and again. Windows stand for their place by rank in the
    heap, so that a chunk costs a few whole numbers a window beside its arrays.
    """
    by_rank = np.lexsort((ends, ranks))
    place = np.empty(len(by_rank), np.int64)
    place[by_rank] = np.arange(len(by_rank))
    order = np.argsort(starts, kind="stable")
    coming, until = memoryview(place[order]), memoryview(np.ascontiguousarray(ends[by_rank]))
    begun = np.searchsorted(starts[order], events, side="left")
    heap: list[int] = []
    chosen, taken = np.full(len(events), -1, np.int64), np.full(len(by_rank), -1, np.int64)
    at = 0
    for n, (position, upto) in enumerate(zip(memoryview(np.ascontiguousarray(events)), memoryview(begun), strict=True)):
        while at < upto:
            heapq.heappush(heap, coming[at])
            at += 1
        while heap and until[heap[0]] <= position:
            heapq.heappop(heap)
        if heap:
            chosen[n] = i = heapq.heappop(heap) if consume else heap[0]
            taken[i] = n
    return np.append(by_rank, -1)[chosen], taken[place]


def _numbers(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).to_numpy().astype(np.int64, copy=False)


def _swept(windows: pa.Table, positions: np.ndarray, consume: bool) -> tuple[np.ndarray, np.ndarray]:
    return sweep(*(_numbers(windows, c) for c in ("start", "end", "rank")), positions, consume)


def _settle(bids: pa.Table, events: pa.Table) -> pa.Table:
    """The bids of one chunk with the position of the event that keeps each, NULL where none does."""
    positions = np.sort(_numbers(events, "seq"))
    _, taken = _swept(bids, positions, True)
    kept = pa.array(np.append(positions, 0)[taken], mask=taken < 0)
    return bids.select(["id", "rank", "start", "end", "chunk"]).append_column("seq", kept)


def _visit(windows: pa.Table, points: pa.Table) -> pa.Table:
    positions = np.sort(_numbers(points, "seq"))
    chosen, _ = _swept(windows, positions, False)
    found = chosen >= 0
    return pa.table({"seq": positions[found], "id": windows.column("id").take(pa.array(chosen[found]))})


def _routed(bids: DataFrame, limits: np.ndarray, chunk_rows: int) -> DataFrame:
    """Bids (with ``at``, the first chunk they may go to) in the next chunk that would take them; others are dropped."""

    def move(batches):
        for batch in batches:
            rank, end, to = batch["rank"].to_numpy(), batch["end"].to_numpy(), batch["at"].to_numpy().copy()
            moving = np.arange(len(batch))
            while len(moving):
                inside = moving[to[moving] < len(limits)]
                moving = inside[limits[to[inside]] <= rank[inside]]
                to[moving] += 1
            first = to * chunk_rows
            good = (to < len(limits)) & (first < end)
            yield batch.assign(chunk=to).loc[good, ["id", "rank", "start", "end", "chunk"]]

    return bids.select("id", "rank", "start", "end", "at").mapInPandas(move, BID + ", chunk long")


class _Held:
    """Bids that chunks keep: one folder a round and chunk; of each chunk its last round counts."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.path, self.last = spark, stage_path(spark, "held-bids"), {}

    def write(self, settled: DataFrame, chunks: list[int], round_: int) -> DataFrame:
        folder = f"{self.path}/round={round_}"
        settled.write.partitionBy("chunk").parquet(folder)
        self.last |= dict.fromkeys(chunks, round_)
        return self.spark.read.schema(BID + ", seq long, chunk long").parquet(folder)

    def read(self, chunks: list[int] | None = None) -> DataFrame:
        """Kept bids of ``chunks``, or of all."""
        own = [(c, r) for c, r in self.last.items() if chunks is None or c in set(chunks)]
        if not own:
            return self.spark.createDataFrame([], BID + ", chunk long, seq long")
        rows = self.spark.read.schema(BID + ", seq long, round long, chunk long").parquet(self.path)
        last = self.spark.createDataFrame(own, "chunk long, round long")
        return rows.join(F.broadcast(last), ["chunk", "round"]).filter(F.col("seq").isNotNull()).select(
            "id", "rank", "start", "end", "chunk", "seq"
        )


def _uncrowded(fresh: DataFrame, capacity: np.ndarray, chunk_rows: int) -> tuple[DataFrame, DataFrame]:
    """New bids that can win in their chunk, and those that cannot, with the first chunk they may go to.

    Of bids on windows that span a chunk, as many as it has events win at most, the lowest ranks.
    A bid behind so many bids on windows that never end cannot win before the events of further
    chunks outnumber them.
    """
    spark = fresh.sparkSession
    first = F.col("chunk") * chunk_rows
    spans = (F.col("start") < first) & (F.col("end") >= first + chunk_rows)
    placed = order_chunks(fresh.filter(spans), ["chunk"], ["rank", "id"])
    counted = running_sum(placed, ["chunk"], ["rank", "id"], F.lit(1).cast("long"), "ahead")
    counted = running_sum(counted, ["chunk"], ["rank", "id"], (F.col("end") == NEVER).cast("long"), "lasting")
    room = np.cumsum(capacity)
    sizes = spark.createDataFrame([(c, int(n), int(room[c] - n)) for c, n in enumerate(capacity)], "chunk long, capacity long, before long")
    counted = stage(counted.join(F.broadcast(sizes), "chunk"), "ranked-bids")
    can = fresh.filter(~spans).select("id", "rank", "start", "end", "chunk").unionByName(
        counted.filter("ahead < capacity").select("id", "rank", "start", "end", "chunk")
    )

    def further(batches):
        for batch in batches:
            reach = np.searchsorted(room, (batch["before"] + batch["lasting"]).to_numpy(), side="right")
            yield batch.assign(at=np.maximum(reach, batch["chunk"].to_numpy() + 1))[["id", "rank", "start", "end", "at"]]

    cannot = counted.filter("ahead >= capacity").select("id", "rank", "start", "end", "chunk", "before", "lasting")
    return can, cannot.mapInPandas(further, BID + ", at long")


def greedy_matches(windows: DataFrame, events: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(``id``, ``seq``): which event takes each of the ``windows`` that are taken.

    ``windows`` has ``id``, ``rank``, ``start`` and ``end`` and holds the positions strictly between; ``NEVER`` is no
    end. ``events`` has one row per position ``seq`` (0 and up). At most one window ends at
    a position, and at most one begins there. ``events`` is read once a round: pass a table.
    """
    spark = windows.sparkSession
    placed = events.select("seq", _chunk_of(F.col("seq"), chunk_rows).alias("chunk"))
    sizes = {r["chunk"]: r["count"] for r in placed.groupBy("chunk").count().collect()}  # one row a chunk
    capacity = np.zeros(max(sizes, default=-1) + 1, np.int64)
    for c, n in sizes.items():
        capacity[c] = n
    limits = np.where(capacity > 0, NEVER, NOTHING)
    held = _Held(spark)
    moved = windows.select("id", "rank", "start", "end", _chunk_of(F.col("start"), chunk_rows).alias("at"))
    round_ = 0
    while True:
        fresh = stage(_routed(moved, limits, chunk_rows), "new-bids")
        asked = {r["chunk"]: r["count"] for r in fresh.groupBy("chunk").count().collect()}
        if not asked:
            return held.read().select("id", "seq")
        later = None
        if any(n > 2 * chunk_rows for n in asked.values()):
            fresh, later = _uncrowded(fresh, capacity, chunk_rows)
        active = sorted(asked)
        bids = fresh.unionByName(held.read(active).drop("seq"))
        own = placed.filter(F.col("chunk").isin(active))
        settled = bids.groupBy("chunk").cogroup(own.groupBy("chunk")).applyInArrow(_settle, BID + ", chunk long, seq long")
        result = held.write(settled, active, round_)
        kept = result.filter(F.col("seq").isNotNull()).groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.max("rank").alias("worst"))
        for r in kept.collect():
            limits[r["chunk"]] = NEVER if r["n"] < capacity[r["chunk"]] else r["worst"]
        moved = result.filter(F.col("seq").isNull()).select("id", "rank", "start", "end", (F.col("chunk") + 1).alias("at"))
        if later is not None:
            moved = moved.unionByName(later)
        round_ += 1


def first_open(windows: DataFrame, points: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(``seq``, ``id``): the window of lowest rank that each of the ``points`` lies in, if any; none is used up.

    Windows that span chunks are kept in a tree of chunks, each on the few largest nodes that it spans,
    and a node keeps its lowest rank; so a chunk reads one window for all that span it.
    """
    spots = points.select("seq", _chunk_of(F.col("seq"), chunk_rows).alias("chunk"))
    chunks = spots.agg(F.coalesce(F.max("chunk") + 1, F.lit(0))).first()[0]
    if not chunks:
        return spots.select("seq", F.lit(None).cast("string").alias("id"))
    low = _chunk_of(F.col("start"), chunk_rows) + 1
    high = F.least(_chunk_of(F.col("end"), chunk_rows), F.lit(chunks).cast("long"))
    levels = F.sequence(F.lit(0), F.lit(chunks.bit_length()))
    bounded = windows.select("id", "rank", "start", "end", low.alias("low"), high.alias("high"))

    def nodes(level: Column) -> Column:
        width = F.call_function("shiftleft", F.lit(1).cast("long"), level)
        first, last = _chunk_of_node(F.col("low") + width - 1, level), _chunk_of_node(F.col("high"), level)
        node = lambda at: F.struct(level.alias("level"), at.alias("node"))
        return F.array(F.when((first < last) & (first % 2 == 1), node(first)), F.when((first < last) & (last % 2 == 1), node(last - 1)))

    spanned = bounded.filter("low < high").select("id", "rank", F.explode(F.array_compact(F.flatten(F.transform(levels, nodes)))).alias("n"))
    best = spanned.groupBy("n.level", "n.node").agg(F.min(F.struct("rank", "id")).alias("best"))
    asked = spots.select("chunk").distinct().select("chunk", F.explode(levels).alias("level")).withColumn(
        "node", _chunk_of_node(F.col("chunk"), F.col("level"))
    )
    cover = asked.join(best, ["level", "node"]).groupBy("chunk").agg(F.min("best").alias("best")).select(
        "best.id", "best.rank", F.lit(-1).cast("long").alias("start"), F.lit(NEVER).alias("end"), "chunk"
    )
    ends = F.array_distinct(F.array(F.col("low") - 1, _chunk_of(F.col("end"), chunk_rows)))
    local = bounded.select("id", "rank", "start", "end", F.explode(ends).alias("chunk")).filter(F.col("chunk") < chunks)
    near = local.unionByName(cover)
    return near.groupBy("chunk").cogroup(spots.groupBy("chunk")).applyInArrow(_visit, "seq long, id string")


def _chunk_of_node(chunk: Column, level: Column) -> Column:
    return F.call_function("shiftright", chunk, level)
