"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.lookup import lookup
from ..operators.staging import stage


def components(links: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every node of ``links`` (``a``, ``b``); the root is the smallest node reachable.

    Alternates large-star and small-star steps on the table of edges until it no longer changes: a
    number of rounds that grows with the logarithm of the nodes. Each round's edges are written, so
    lineage stays short. A node with very many links is cut over tasks by ``lookup``.
    """
    edges = stage(links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("_m"))
        large = lookup(both.filter(F.col("v") > F.col("u")), least, ["u"], "inner").select(F.col("v").alias("u"), F.col("_m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("_m"))
        small = lookup(large, lowest, ["u"], "inner").select(
            F.explode(F.array(F.struct(F.col("u"), F.col("_m").alias("v")), F.struct(F.col("v").alias("u"), F.col("_m").alias("v")))).alias("e")
        ).select("e.*")
        edges = stage(small.filter(F.col("u") != F.col("v")).distinct(), "edges")
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = now
