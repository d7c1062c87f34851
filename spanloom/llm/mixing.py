"""Mixing sources to target weights by fixed-length token blocks.

Each source's documents, in hash order, are one stream of tokens cut into blocks of fixed length.
The output is cut into shards of slots. Every slot draws its source by a seeded hash against the cumulative
weights, so a shard's counts by source are a multinomial draw; sums over the shards then differ
from the targets by about the square root of them, and that is made good over all shards alike: of a source's
slots, numbered in the order of a second hash, those beyond its target go to sources that are short of theirs.
The k-th slot of a source takes the block at the k-th place of the source's own pseudorandom permutation,
a new one for each pass over the source. Slots and blocks are joined by index.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from ..operators.lookup import lookup
from ..operators.staging import stage
from .common import WORD, exclusive_offsets, explode_range, parallelism, permuted

BLOCK = 64
SHARD_SLOTS = 1024
MAX_PASSES = 3
CHUNK_ROWS = 1024
CELL = 32


def sized(df: DataFrame) -> DataFrame:
    """Rows as (``doc_id``, ``source``, ``size``) with the number ``copies`` of equal ones; size in words."""
    words = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    return df.select("doc_id", "source", words.alias("size")).groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("copies"))


def source_plan(docs: DataFrame, block: int) -> DataFrame:
    """Per source: its words, weight, target, number of blocks and slots, and its first slot number.

    Weights 1, 2, 3 repeat over the sources by code point, NULL last. A target is
    ``min(3 * words, level * weight)`` with the level at which the targets sum to all words: the
    result of resharing excess by weight until no source is above its limit. One task orders the
    table of sources.
    """
    whole = Window.partitionBy()
    rows = docs.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("words"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    rows = rows.withColumn("ordinal", number.cast("long")).withColumn("weight", (F.col("ordinal") % 3 + 1).cast("double"))
    rows = rows.withColumn("cap", F.col("words") * F.lit(float(MAX_PASSES))).withColumn("fill", F.col("cap") / F.col("weight"))
    by_fill = Window.orderBy("fill", "ordinal")
    below = F.coalesce(F.sum("cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    above = F.sum("weight").over(by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = (F.sum("words").over(whole) - below) / above
    rows = rows.withColumn("_level", F.when(level <= F.col("fill"), level))
    rows = rows.withColumn("_level", F.first("_level", ignorenulls=True).over(by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least(F.col("cap"), F.coalesce(F.col("_level") * F.col("weight"), F.col("cap")))
    blocks = F.ceil(F.col("words") / block).cast("long")
    slots = F.when(F.col("words") > 0, F.least(F.round(F.col("target") * F.col("blocks") / F.col("words")).cast("long"), F.col("blocks") * MAX_PASSES)).otherwise(F.lit(0).cast("long"))
    rows = rows.withColumn("target", target).withColumn("blocks", blocks).withColumn("slots", slots)
    before = Window.orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    return rows.select(
        "source", "ordinal", "words", "target", "blocks", "slots",
        F.coalesce(F.sum("slots").over(before), F.lit(0)).alias("first_slot"), F.sum("slots").over(whole).alias("all_slots"),
    )


def _drawn(sources: DataFrame, total: int, partitions: int, seed: int) -> DataFrame:
    """Every output slot with the source that it draws: the owner of a place that a hash picks among all places."""
    number = F.col("id")
    slots = sources.sparkSession.range(0, total, 1, partitions).select(
        F.floor(number / SHARD_SLOTS).cast("long").alias("out_shard"), (number % SHARD_SLOTS).cast("int").alias("out_slot"),
        F.pmod(F.xxhash64(F.lit(seed), F.lit("draw"), number), F.lit(max(total, 1))).alias("_at"),
    )
    # Places are joined to their owners cell by cell: a cell has few places, so few owners.
    last = F.col("first_slot") + F.col("slots") - 1
    cell = lambda at: F.floor(at / CELL).cast("long")
    spans = sources.filter("slots > 0").select(
        "ordinal", F.col("first_slot").alias("_low"), last.alias("_high"), cell(F.col("first_slot")).alias("_first"),
        (cell(last) - cell(F.col("first_slot")) + 1).alias("_cells"),
    )
    owners = explode_range(spans, "_cells", "_c", partitions).select("ordinal", "_low", "_high", (F.col("_first") + F.col("_c")).alias("_cell"))
    return slots.withColumn("_cell", cell(F.col("_at"))).join(owners.hint("merge"), "_cell").filter(
        F.col("_at").between(F.col("_low"), F.col("_high"))
    ).select("ordinal", "out_shard", "out_slot")


def draw_slots(sources: DataFrame, partitions: int, seed: int) -> DataFrame:
    """Every output slot: ``out_shard``, ``out_slot``, its source ``ordinal``, and the ``pass`` and ``block`` it takes.

    Each source has exactly its ``slots``. ``sources`` is read several times: pass a table.
    """
    order = F.xxhash64(F.lit(seed), F.lit("order"), "out_shard", "out_slot")
    total = sources.agg(F.coalesce(F.max("all_slots"), F.lit(0)).cast("long")).first()[0]
    drawn = _drawn(sources, total, partitions, seed).withColumn("_order", order)
    drawn = stage(drawn.withColumn("_chunk", F.pmod("_order", F.lit(max(1, math.ceil(total / CHUNK_ROWS))).cast("long"))), "mix-draws")
    # Each step is staged once for all its readers: one plan of all steps repeats them and outgrows the driver.
    counts = stage(drawn.groupBy("ordinal", "_chunk").agg(F.count(F.lit(1)).alias("_count")), "mix-draw-counts")
    offsets = exclusive_offsets(counts, ["ordinal"], "_chunk", "_count", "_offset").select("ordinal", "_chunk", "_offset")
    inside = Window.partitionBy("ordinal", "_chunk").orderBy("_order", "out_shard", "out_slot")
    numbered = drawn.withColumn("_inner", F.row_number().over(inside) - 1).join(offsets.hint("merge"), ["ordinal", "_chunk"])
    totals = counts.groupBy("ordinal").agg(F.sum("_count").alias("_sum"))
    drawn_sum = F.coalesce("_sum", F.lit(0))
    balance = sources.select("ordinal", "slots", "blocks").join(totals, "ordinal", "left").select(
        "ordinal", "slots", "blocks", drawn_sum.alias("_sum"),
        F.greatest(drawn_sum - F.col("slots"), F.lit(0)).alias("_over"), F.greatest(F.col("slots") - drawn_sum, F.lit(0)).alias("_short"),
    )
    balance = exclusive_offsets(balance, [], "ordinal", "_over", "_over_before")
    balance = stage(exclusive_offsets(balance, [], "ordinal", "_short", "_short_before"), "mix-balance")
    numbered = numbered.select("ordinal", (F.col("_offset") + F.col("_inner")).alias("k"), "out_shard", "out_slot")
    numbered = stage(numbered, "mix-numbered")
    owned = lookup(numbered, balance.select("ordinal", "slots", "_over_before"), ["ordinal"], "inner")
    free = owned.filter(F.col("k") >= F.col("slots")).select((F.col("_over_before") + F.col("k") - F.col("slots")).alias("_free"), "out_shard", "out_slot")
    wanted = explode_range(balance.select("ordinal", "_sum", "_short", "_short_before"), "_short", "_i", partitions).select(
        (F.col("_short_before") + F.col("_i")).alias("_free"), "ordinal", (F.col("_sum") + F.col("_i")).alias("k")
    )
    moved = free.join(wanted.hint("merge"), "_free").select("ordinal", "k", "out_shard", "out_slot")
    slots = owned.filter(F.col("k") < F.col("slots")).select("ordinal", "k", "out_shard", "out_slot").unionByName(moved)
    slots = lookup(slots, balance.select("ordinal", "blocks"), ["ordinal"], "inner")
    turn = F.floor(F.col("k") / F.col("blocks")).cast("long")
    source_seed = F.xxhash64(F.lit(seed), F.col("ordinal"), turn)
    return slots.select(
        "out_shard", "out_slot", "ordinal", "k", turn.alias("pass"), permuted(F.col("k") % F.col("blocks"), F.col("blocks"), source_seed).alias("block")
    )


def pack(docs: DataFrame, sources: DataFrame, rows: int, block: int, partitions: int, seed: int) -> DataFrame:
    """Pieces of documents: (``doc_id``, ``source``, ``size``, ``ordinal``, ``copy``, ``block``, ``first_word``, ``piece`` words)."""
    chunks = max(1, math.ceil(rows / CHUNK_ROWS))
    placed = lookup(docs.filter(F.col("size") > 0), sources.select("source", "ordinal"), ["source"], null_safe=True)
    placed = placed.withColumn("_hash", F.xxhash64(F.lit(seed), "doc_id", "size"))
    placed = placed.withColumn("_chunk", F.pmod(F.col("_hash"), F.lit(chunks))).withColumn("_words", F.col("size") * F.col("copies"))
    sums = stage(placed.groupBy("ordinal", "_chunk").agg(F.sum("_words").alias("_sum")), "mix-word-counts")
    offsets = exclusive_offsets(sums, ["ordinal"], "_chunk", "_sum", "_offset").select("ordinal", "_chunk", "_offset")
    inside = Window.partitionBy("ordinal", "_chunk").orderBy("_hash", F.col("doc_id").asc_nulls_first(), "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("_inner", F.coalesce(F.sum("_words").over(inside), F.lit(0))).join(offsets, ["ordinal", "_chunk"])
    placed = placed.select("doc_id", "source", "size", "ordinal", "copies", (F.col("_offset") + F.col("_inner")).alias("_first"))
    copies = explode_range(placed, "copies", "copy", partitions).withColumn("_start", F.col("_first") + F.col("copy") * F.col("size"))
    end = F.col("_start") + F.col("size")
    pieces = copies.withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("_start") / block).cast("long"), F.floor((end - 1) / block).cast("long")))
    )
    low = F.greatest(F.col("_start"), F.col("block") * block)
    return pieces.select(
        "doc_id", "source", "size", "ordinal", "copy", "block",
        (low - F.col("_start")).alias("first_word"), (F.least(end, (F.col("block") + 1) * block) - low).alias("piece"),
    )


class Mix:
    """A drawn mix of ``df`` (columns ``doc_id``, ``text``, ``source``; others are not read).

    NULL texts have no words. NULL is a source of its own, the last. Documents without words are
    listed and take nothing. Equal rows are packed one after the other and listed once each. An
    empty table gives an empty mix. Nothing depends on the order of the input rows.
    """

    def __init__(self, df: DataFrame, seed: int = 0, block: int = BLOCK):
        self.partitions = parallelism(df.sparkSession)
        self.docs = stage(sized(df), "mix-docs")
        self.sources = stage(source_plan(self.docs, block), "mix-sources")
        rows = self.docs.count()
        self.slots = draw_slots(self.sources, self.partitions, seed)
        self.pieces = pack(self.docs, self.sources, rows, block, self.partitions, seed)

    def shard_counts(self) -> DataFrame:
        """Slots of each source in each output shard."""
        return self.slots.groupBy("out_shard", "ordinal").agg(F.count(F.lit(1)).alias("slots"))

    def manifest(self, how: str = "inner") -> DataFrame:
        """What stands in every output slot: the pieces of documents of its block, in order of ``copy``, ``first_word``."""
        # Sizes are estimated from before the expansion of ranges, so the planner must not choose a broadcast.
        return self.slots.join(self.pieces.hint("merge"), ["ordinal", "block"], how)

    def taken(self) -> DataFrame:
        """One row per row of the input: words of it that stand in the output, repeats counted."""
        words = F.when(F.col("out_slot").isNotNull(), F.col("piece")).otherwise(F.lit(0))
        sums = self.manifest("right").groupBy("doc_id", "source", "size", "copy").agg(F.sum(words).alias("taken"))
        empty = explode_range(self.docs.filter(F.col("size") == 0), "copies", "copy", self.partitions).select(
            "doc_id", "source", "size", "copy", F.lit(0).cast("long").alias("taken")
        )
        plan = self.sources.select("source", F.col("words").alias("source_size"), "target")
        return lookup(sums.unionByName(empty), plan, ["source"], null_safe=True).select("doc_id", "source", "size", "source_size", "target", "taken")


def mixed_documents(df: DataFrame, seed: int = 0) -> DataFrame:
    """Rows of ``df``, each as often as the mix takes it: uses per word, rounded up or down by a seeded hash.

    Expected repeats equal the uses, so the sources meet their targets in words; texts stay whole.
    """
    taken = Mix(df, seed).taken().groupBy("doc_id", "source", "size")
    uses = stage(taken.agg((F.avg("taken") / F.greatest(F.col("size"), F.lit(1))).alias("uses")), "mix-uses")
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), "doc_id", "source",
        F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    # A row for each document, small as its file may be: the planner must not choose a broadcast.
    found = lookup(rows, uses.hint("merge"), ["doc_id", "source", "size"], null_safe=True)
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id", F.crc32("row.text")), F.lit(1 << 20)) / float(1 << 20)
    times = F.floor(F.col("uses") + draw).cast("int")
    repeated = found.withColumn("time", F.explode(F.when(times > 0, F.sequence(F.lit(1), times)).otherwise(F.array().cast("array<int>"))))
    return repeated.select("row.*")
