"""Many-to-one joins whose fact side may have hot keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def lookup(facts: DataFrame, dim: DataFrame, on: list[str], how: str = "left", null_safe: bool = False) -> DataFrame:
    """Join every fact row to at most one ``dim`` row (``dim`` is unique on ``on``).

    ``dim`` usually comes straight out of ``groupBy(on)``. Spark would then join in the
    aggregate's own partitioning, with no exchange under the join on that side, and adaptive
    execution can only split a hot key where both sides have one. The extra join column is a
    function of the key, so it changes no result, but it gives both sides their own exchange:
    a key that holds a third of the facts is cut over many tasks at run time, and a ``dim``
    that proves small at run time is broadcast by its measured size.
    """
    spread = F.pmod(F.hash(*on), F.lit(2))
    left = facts.withColumn("_spread", spread)
    right = dim.withColumn("_spread", spread)
    if not null_safe:
        return left.join(right, [*on, "_spread"], how).drop("_spread")
    right = right.select(*[F.col(c).alias(f"_dim_{c}") if c in on else F.col(c) for c in right.columns if c != "_spread"],
                         F.col("_spread").alias("_dim_spread"))
    condition = reduce(
        lambda a, b: a & b,
        [F.col(c).eqNullSafe(F.col(f"_dim_{c}")) for c in on],
        F.col("_spread") == F.col("_dim_spread"),
    )
    return left.join(right, condition, how).drop("_spread", "_dim_spread", *[f"_dim_{c}" for c in on])
