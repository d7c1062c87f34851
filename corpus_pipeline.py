"""Corpus pipeline: language ID, near duplicates, benchmark decontamination, mixing, sharding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from spanloom.llm import classify, contamination, jaccard, mixing, sharding
from spanloom.operators.staging import stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known: those that language ID rejects go."""
    found = classify.identify_language(docs, classify.fit_language(docs))
    return found.filter(~F.col("rejected")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return jaccard.one_of_each(docs, 5, 80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return contamination.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to target weights takes them."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in random order in 16 shards."""
    return sharding.shard_rows(docs, 16)


STAGES = [
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

# The trained language classifier and the alignment scores cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written to shared storage and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
