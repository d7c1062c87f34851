"""Helpers of the training-data operators: tables, offsets, bounded expansion, index permutations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# Fixed value: what counts as a word in every operator that counts words.
WORD = r"[^\x20\x09-\x0D]+"

# Rounds of the index permutation, and steps in which an index that fell outside is sent on. Fewer than 16
# fall outside for lengths under 256; of longer ones less than a 16th does, so 16 steps are never used up.
ROUNDS = 4
WALK = 16
SPREAD = 4096

# Bits that tell which keys are in no set, whatever the set: one row of 2^15 bits each in a table of 4 MB at most.
SET_BITS = 1 << 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns of these names in any case, so that outputs may take them."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out() -> Column:
    """Rows whose labels no model may learn from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def null_safe_key(*columns: str) -> Column:
    """One non-null text per distinct tuple, NULL included: for joins and windows on nullable keys."""
    return F.concat_ws(
        "\x00", *[F.concat(F.when(F.col(c).isNull(), F.lit("n")).otherwise(F.lit("v")), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns]
    )


def maybe_in(df: DataFrame, column: str, keys: DataFrame, out: str) -> DataFrame:
    """``df`` with ``out``: whether ``column`` can be among the values of ``keys`` of that name. False is certain.

    Hashes of the keys set bits in a table of fixed size, which is broadcast; ``df`` is not shuffled. The more keys,
    the more rows are True without need. Rows without ``column`` are False. ``column`` has one type on both sides.
    """
    hashed = lambda: F.pmod(F.xxhash64(column), F.lit(SET_BITS).cast("long"))
    key, width = unused(df, "_bits"), 1 << 15
    bits = keys.filter(F.col(column).isNotNull()).select(hashed().alias("_at")).groupBy(F.call_function("div", "_at", F.lit(width)).alias(f"{key}_row")).agg(
        F.bitmap_construct_agg(F.col("_at") % width).alias(key)
    )
    at = hashed() % width
    # Bit b of a bitmap is bit b mod 8, from the lowest, of its byte b div 8.
    byte = F.conv(F.hex(F.substring(key, (F.call_function("div", at, F.lit(8)) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.call_function("shiftright", byte, (at % 8).cast("int")) % 2 == 1
    found = df.withColumn(f"{key}_row", F.when(F.col(column).isNotNull(), F.call_function("div", hashed(), F.lit(width))))
    joined = found.join(F.broadcast(bits), f"{key}_row", "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce(is_set, F.lit(False)).alias(out))


def exclusive_offsets(sizes: DataFrame, group: list[str], index: str, value: str, out: str, fan: int = 1024) -> DataFrame:
    """Sum of ``value`` over the rows of the group with a smaller ``index`` (0 and up, one row each).

    Two levels of windows, so that no task holds more than ``fan`` rows of the first level or
    one ``fan``-th of the index at the second.
    """
    rows = sizes.withColumn("_super", F.floor(F.col(index) / fan).cast("long"))
    totals = rows.groupBy(*group, "_super").agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(*group).orderBy("_super").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(*[F.col(g).alias(f"_b_{g}") for g in group], F.col("_super").alias("_b_super"),
                          F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))
    on = F.col("_super") == F.col("_b_super")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"_b_{g}"))
    inner = Window.partitionBy(*group, "_super").orderBy(index).rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("_inner", F.coalesce(F.sum(value).over(inner), F.lit(0)))
        .join(bases, on)
        .withColumn(out, F.col("_base") + F.col("_inner"))
        .drop("_super", "_inner", "_base", "_b_super", *[f"_b_{g}" for g in group])
    )


def explode_range(df: DataFrame, count: str, out: str, partitions: int) -> DataFrame:
    """Each row once for every ``out`` in 0 .. ``count`` - 1; rows with long ranges are dealt over all tasks."""
    last = F.floor((F.col(count) - 1) / SPREAD).cast("long")
    parts = df.filter(F.col(count) > 0).withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    dealt = parts.repartition(partitions, F.xxhash64(*[c for c in df.columns], "_part"))
    low = F.col("_part") * SPREAD
    return dealt.withColumn(out, F.explode(F.sequence(low, F.least(low + SPREAD, F.col(count)) - 1))).drop("_part")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, evaluated once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def permuted(index: Column, length: Column, seed: Column) -> Column:
    """Place of ``index`` in a seeded pseudorandom permutation of 0 .. ``length`` - 1 (``length`` below 2^42).

    A Feistel network over two digits, whose bases multiply to little more than ``length``; a place beyond
    the end is sent through again until it is inside.
    """
    size = length.cast("long")
    high = F.ceil(F.sqrt(size)).cast("long")
    shape = F.struct(size.alias("n"), high.alias("a"), F.call_function("div", size + high - 1, high).alias("b"), seed.alias("seed"))

    def mix(s: Column, i: Column, digit: Column, side: int) -> Column:
        return F.xxhash64(s["seed"], i, digit, F.lit(side))

    def sent(s: Column, x: Column) -> Column:
        def step(d: Column, i: Column) -> Column:
            left = bind(F.pmod(d["l"] + F.pmod(mix(s, i, d["r"], 0), s["a"]), s["a"]), lambda v: v)
            return bind(left, lambda v: F.struct(v.alias("l"), F.pmod(d["r"] + F.pmod(mix(s, i, v, 1), s["b"]), s["b"]).alias("r")))

        digits = F.struct(F.call_function("div", x, s["b"]).alias("l"), F.pmod(x, s["b"]).alias("r"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), digits, step, lambda d: d["l"] * s["b"] + d["r"])

    def walked(s: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(WALK)), sent(s, index.cast("long")), lambda x, _: F.when(x < s["n"], x).otherwise(sent(s, x))
        )

    return bind(shape, walked)
