"""Numbering with limits: a row counts if fewer rows of its key than its limit counted before it.

Each row is a step ``d -> d + (d < limit)`` on the number counted so far. A run of rows composes to
``d -> d + rows - (thresholds up to d)``: a row with a limit fails for every start from its threshold on. So
the rows of a key in one chunk are described by a sorted list of thresholds, whatever the start. Only keys
that reach over a chunk's border need it, at most two a chunk; one pass evaluates their
lists from chunk to chunk and gives every chunk its start. The number of jobs is fixed.
"""

from __future__ import annotations

from bisect import insort

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .ordered import CHUNK
from .staging import stage

BLOCK = 1024
UNLIMITED = (1 << 63) - 1


class Removed:
    """A growing sorted list of whole numbers that are taken out of 0, 1, 2, ..."""

    def __init__(self) -> None:
        self.blocks: list[list[int]] = [[]]

    def take(self, m: int) -> int:
        """Take out, and return, the ``m``-th (from 0) of the numbers that are left."""
        before, at = 0, len(self.blocks) - 1
        for i, block in enumerate(self.blocks):
            # block[j] has block[j] - before - j numbers left below it
            if block and block[-1] - before - len(block) + 1 > m:
                at = i
                break
            before += len(block)
        else:
            before -= len(self.blocks[-1])
        own = self.blocks[at]
        low, high = 0, len(own)
        while low < high:
            middle = (low + high) // 2
            if own[middle] - before - middle <= m:
                low = middle + 1
            else:
                high = middle
        value = m + before + low
        insort(own, value)
        if len(own) > BLOCK:
            self.blocks[at : at + 1] = [own[: BLOCK // 2], own[BLOCK // 2 :]]
        return value

    def sorted(self) -> list[int]:
        return [x for block in self.blocks for x in block]


def thresholds(limits: list[int], largest: int) -> tuple[int, list[int]]:
    """Rows that can count, and the sorted starts (up to ``largest``) from each of which one more of them does not."""
    removed, beyond, counted, able = Removed(), 0, 0, 0
    for limit in limits:
        left = limit - counted
        if left <= 0:
            continue  # fails from any start
        able += 1
        counted += 1
        # A start with as many distinct outcomes below it as are left meets the limit.
        if left <= largest:
            if removed.take(left) > largest:
                beyond += 1
    found = removed.sorted()
    return able, found[: len(found) - beyond] if beyond else found


def counted_from(start: int, limits: list[int]) -> list[int]:
    """Number of each row, 0 where it does not count."""
    out = []
    for limit in limits:
        if start < limit:
            start += 1
            out.append(start)
        else:
            out.append(0)
    return out


def _sorted(table: pa.Table, columns: list[str]) -> pa.Table:
    keys = [(c, "ascending") for c in columns]
    return table.take(pc.sort_indices(table, sort_keys=keys, null_placement="at_start"))


def _in_utc(table: pa.Table) -> pa.Table:
    """Times as results must have them, whatever the zone of the session."""
    zoned = lambda kind: pa.types.is_timestamp(kind) and kind.tz is not None
    return table.cast(pa.schema([pa.field(f.name, pa.timestamp("us", "UTC") if zoned(f.type) else f.type) for f in table.schema]))


def _limits(table: pa.Table, column: str) -> list[int]:
    return pc.fill_null(table.column(column).combine_chunks(), UNLIMITED).to_pylist()


def capped_numbers(chunked: DataFrame, by: str, order: list[str], limit: str, out: str) -> DataFrame:
    """Rows of ``chunked`` that count, with their number (from 1) in their key as ``out``.

    ``chunked`` comes from ``order_chunks`` on (``by``, ``order``) and is read three times: stage it. A NULL
    ``limit`` is none.
    """
    sizes = chunked.groupBy(CHUNK, by).agg(F.count(F.lit(1)).alias("_rows"))
    key = Window.partitionBy(by)
    before = F.coalesce(F.sum("_rows").over(key.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # Consecutive ranges: only the first and the last key of a chunk can reach over its borders.
    spanning = stage(
        sizes.withColumns({"_before": before, "_chunks": F.count(F.lit(1)).over(key)}).filter("_chunks > 1").select(CHUNK, by, "_before"),
        "spanning-keys",
    )

    def composed(table: pa.Table) -> pa.Table:
        table = _sorted(table, order)
        first = {c: table.column(c)[0].as_py() for c in (CHUNK, by, "_before")}
        # From 0 it is enough to know the outcome.
        able, found = thresholds(_limits(table, limit), first["_before"])
        return pa.table({CHUNK: pa.array([first[CHUNK]], pa.int32()), by: [first[by]], "able": pa.array([able], pa.int64()), "found": pa.array([found], pa.list_(pa.int64()))})

    own = chunked.join(F.broadcast(spanning), [CHUNK, by]).select(CHUNK, by, "_before", *order, limit)
    kind = chunked.schema[by].dataType.simpleString()
    lists = own.groupBy(CHUNK, by).applyInArrow(composed, f"{CHUNK} int, {by} {kind}, able long, found array<long>")

    def chain(batches):
        key_, counted = None, 0
        for batch in batches:
            starts = []
            for name, able, found in zip(batch[by], batch["able"], batch["found"], strict=True):
                if name != key_:
                    key_, counted = name, 0
                starts.append(counted)
                counted += able - int(np.searchsorted(np.asarray(found), counted, side="right"))
            yield pd.DataFrame({CHUNK: batch[CHUNK], by: batch[by], "_start": np.array(starts, np.int64)})

    starts = lists.repartition(by).sortWithinPartitions(by, CHUNK).mapInPandas(chain, f"{CHUNK} int, {by} {kind}, _start long")
    rows = chunked.join(F.broadcast(stage(starts, "chunk-starts")), [CHUNK, by], "left")
    names = [c for c in chunked.columns if c != CHUNK]

    def number(table: pa.Table) -> pa.Table:
        table = _sorted(table, [by, *order])
        codes = table.column(by).combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        borders = np.flatnonzero(np.diff(codes, prepend=-1)).tolist() + [len(codes)]
        limits, begun = _limits(table, limit), pc.fill_null(table.column("_start").combine_chunks(), 0).to_pylist()
        numbers: list[int] = []
        for low, high in zip(borders, borders[1:], strict=False):
            numbers += counted_from(begun[low], limits[low:high])
        numbered = _in_utc(table.select(names)).append_column(out, pa.array(numbers, pa.int64()))
        return numbered.filter(pc.greater(numbered.column(out), 0))

    schema = StructType([*chunked.select(*names).schema.fields, StructField(out, LongType())])
    return rows.groupBy(CHUNK).applyInArrow(number, schema)
