"""Order-dependent operators (running value, next value, numbering, as-of) safe for hot keys.

A plain ``Window.partitionBy(key)`` puts a whole key in one task. Here the rows are
range-partitioned on (key, order), so a key of any size is cut into chunks of about equal
size, by sampling. Windows run inside (chunk, key). What has to cross a chunk boundary is one
value per chunk: chunks are consecutive ranges, so only the first (or last) key of a chunk can
continue from a neighbour. That carry table therefore has at most one row per chunk, whatever
the data, and is broadcast. Chunk numbers are staged, so every reader sees the same cut.

``order`` must be a total order within the key: end it with a column that tells all rows apart,
exact copies too (an id stored with the row, not one made on the fly, so that a retried task
places every row where the first attempt did). Then any group, copies included, can be cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .staging import stage

CHUNK = "_chunk"


def order_chunks(df: DataFrame, by: list[str], order: list[str], chunks: int | None = None) -> DataFrame:
    """Cut ``df`` into ordered chunks on (``by``, ``order``); ``by`` must not be NULL."""
    keys = [*by, *order]
    ranged = df.repartitionByRange(chunks, *keys) if chunks else df.repartitionByRange(*keys)
    return stage(ranged.withColumn(CHUNK, F.spark_partition_id()), "chunks")


def _inside(by: list[str], order: list[str]):
    return Window.partitionBy(CHUNK, *by).orderBy(*order)


def _with_carry(rows: DataFrame, groups: DataFrame, by: list[str], carry: Column) -> DataFrame:
    """Attach the carry of each (chunk, key). ``groups`` has one row per (chunk, key)."""
    bounded = groups.select(CHUNK, *by, carry.alias("_carry")).filter(F.col("_carry").isNotNull())
    return rows.join(F.broadcast(bounded), [CHUNK, *by], "left")


def running_last(chunked: DataFrame, by: list[str], order: list[str], value: Column, out: str) -> DataFrame:
    """Last non-null ``value`` up to and including each row, per key."""
    rows = chunked.withColumn("_value", value)
    position = F.struct(*order)
    groups = rows.groupBy(CHUNK, *by).agg(
        F.max_by("_value", F.when(F.col("_value").isNotNull(), position)).alias("_tail")
    )
    before = Window.partitionBy(*by).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    inner = F.last("_value", ignorenulls=True).over(
        _inside(by, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carried = _with_carry(
        rows.withColumn("_inner", inner), groups, by, F.last("_tail", ignorenulls=True).over(before)
    )
    return carried.withColumn(out, F.coalesce("_inner", "_carry")).drop("_value", "_inner", "_carry")


def next_value(chunked: DataFrame, by: list[str], order: list[str], value: Column, out: str) -> DataFrame:
    """``value`` of the following row of the same key; NULL on the last. ``value`` is not NULL."""
    rows = chunked.withColumn("_value", value)
    groups = rows.groupBy(CHUNK, *by).agg(F.min_by("_value", F.struct(*order)).alias("_head"))
    inner = F.lead("_value").over(_inside(by, order))
    carried = _with_carry(
        rows.withColumn("_inner", inner), groups, by, F.lead("_head").over(Window.partitionBy(*by).orderBy(CHUNK))
    )
    return carried.withColumn(out, F.coalesce("_inner", "_carry")).drop("_value", "_inner", "_carry")


def row_numbers(chunked: DataFrame, by: list[str], order: list[str], out: str) -> DataFrame:
    """1-based position of each row within its key."""
    groups = chunked.groupBy(CHUNK, *by).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*by).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    inner = F.row_number().over(_inside(by, order)).cast("bigint")
    carried = _with_carry(chunked.withColumn("_inner", inner), groups, by, F.sum("_size").over(before))
    return carried.withColumn(out, F.col("_inner") + F.coalesce("_carry", F.lit(0))).drop("_inner", "_carry")


def running_sum(chunked: DataFrame, by: list[str], order: list[str], value: Column, out: str) -> DataFrame:
    """Sum of ``value`` (never NULL) over the rows of the key before each row."""
    rows = chunked.withColumn("_value", value)
    groups = rows.groupBy(CHUNK, *by).agg(F.sum("_value").alias("_total"))
    before = Window.partitionBy(*by).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    inner = F.coalesce(F.sum("_value").over(_inside(by, order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    carried = _with_carry(rows.withColumn("_inner", inner), groups, by, F.sum("_total").over(before))
    return carried.withColumn(out, F.col("_inner") + F.coalesce("_carry", F.lit(0))).drop("_value", "_inner", "_carry")


def asof_backward(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    ts: str,
    left_tie: list[str],
    right_tie: list[str],
    out: str,
    chunks: int | None = None,
) -> DataFrame:
    """Left rows with ``out``: the latest right row of the same key with right ``ts`` <= left ``ts``.

    Equal times match; among right rows of one time the last in ``right_tie`` order wins. Left
    rows keep all their columns; ``out`` is a struct of the right columns, NULL without a match.
    With ``by`` empty the whole table is one ordered line. ``ts`` and the ties order each side
    totally.
    """
    events = left.select(*by, ts, F.lit(1).alias("_side"), F.struct(*left.columns).alias("_left"))
    targets = right.filter(F.col(ts).isNotNull()).select(
        *by, ts, F.lit(0).alias("_side"), F.struct(*right.columns).alias("_right")
    )
    line = targets.unionByName(events, allowMissingColumns=True)
    order = [ts, "_side", *[f"_right.{c}" for c in right_tie], *[f"_left.{c}" for c in left_tie]]
    filled = running_last(order_chunks(line, by, order, chunks), by, order, F.col("_right"), out)
    return filled.filter(F.col("_side") == 1).select("_left.*", out)
