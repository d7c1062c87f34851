"""Sharding: two-pass external shuffle into shards of equal row counts.

Pass one scatters the rows into memory-sized buckets by a seeded hash and writes them to shared
storage. Pass two shuffles each bucket by Fisher-Yates. The buckets, one after the other, are the
global order; dealing that order out in turn gives shards whose row counts differ by one at most.
A bucket is shuffled as the numbers of its rows; the rows, whatever their length, meet their places
in a sorted join, so no task holds the texts of a bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.staging import stage
from .common import exclusive_offsets, parallelism, without

BUCKET_ROWS = 1024
BUCKET_BYTES = 4 << 20


def fisher_yates(length: Column, seed: list[Column]) -> Column:
    """Permutation of 0 .. ``length`` - 1 by the inside-out Fisher-Yates shuffle.

    Step i draws j from 0 .. i, puts i at place j and moves what stood there to the end.
    """

    def step(done: Column, i: Column) -> Column:
        j = F.pmod(F.xxhash64(*seed, i), i + 1).cast("int")
        swapped = F.concat(
            F.slice(done, F.lit(1), j), F.array(i), F.slice(done, j + 2, i - j - 1), F.array(F.element_at(done, j + 1))
        )
        return F.when(j == i, F.concat(done, F.array(i))).otherwise(swapped)

    later = F.when(length > 1, F.sequence(F.lit(1), length - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(later, F.array(F.lit(0)), step)


def shard_rows(
    df: DataFrame, shards: int, seed: int = 0, text: str = "text",
    bucket_rows: int = BUCKET_ROWS, bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """All rows of ``df`` in random order, with ``shard`` (0 and up) and ``slot`` (gapless from 0 in each shard).

    Every row is placed once, whatever it holds: NULLs, empty or very long texts and repeated rows
    are rows like any other (equal rows get places of their own and spread over buckets like others).
    An empty table gives an empty result. Input columns named ``shard`` or ``slot`` are replaced.
    The scatter hashes the row's number in the scan, so a bucket's size never depends on how often
    a key or text occurs; what pass two reads is the written scatter, so retried tasks see the same
    buckets.
    """
    rows = without(df, "shard", "slot")
    totals = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col(text))).alias("b")).first()
    buckets = max(1, -(-totals.n // bucket_rows), -(-(totals.b or 0) // bucket_bytes))
    numbered = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"), F.monotonically_increasing_id().alias("_id"))
    scatter = F.pmod(F.xxhash64(F.lit(seed), F.col("_id")), F.lit(buckets))
    scattered = stage(numbered.withColumn("_bucket", scatter), "scatter")

    counts = scattered.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    offsets = exclusive_offsets(counts, [], "_bucket", "_n", "_offset").select("_bucket", "_offset")
    filled = scattered.groupBy("_bucket").agg(F.sort_array(F.collect_list("_id")).alias("_ids"))
    order = fisher_yates(F.size("_ids"), [F.lit(seed), F.col("_bucket")])
    # Numbers are small, so adaptive execution would leave all buckets to one task.
    dealt = (
        filled.join(offsets, "_bucket")
        .repartition(parallelism(df.sparkSession), F.xxhash64("_bucket"))
        .withColumn("_order", order)
        .select("_offset", F.posexplode(F.transform("_order", lambda i: F.get(F.col("_ids"), i))).alias("_pos", "_id"))
    )
    place = F.col("_offset") + F.col("_pos")
    places = dealt.select("_id", F.pmod(place, F.lit(shards)).cast("int").alias("shard"), F.floor(place / shards).cast("long").alias("slot"))
    # Sizes are estimated from before the expansion of the buckets, so the planner must not choose a broadcast.
    return scattered.select("_id", "_row").join(places.hint("merge"), "_id").select("_row.*", "shard", "slot")


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write sharded rows as one folder per shard, rows of a file in slot order."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def digest(sharded: DataFrame) -> DataFrame:
    """The per-document columns of the sharding query."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return sharded.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
