"""Stores laid out for what is asked of them again and again: spans by trace, dependencies by run.

A store is a bucketed table: rows of one trace (or run) are in one file, in order. Reports by that key
then neither shuffle nor sort the stored side. One bucket is read by one task, so give it as many
buckets as make a bucket fit one; where one trace holds more than a bucket's share of the rows,
take ``fill_over_trace`` over the staged table, which cuts such a trace over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .runs import run_attributes
from .spans import with_attributes

TRACE_KEY = "trace_key"


def trace_key(trace_id: Column) -> Column:
    """A key that is never NULL, so that spans without a trace are a bucketed group too."""
    return F.coalesce(F.concat(F.lit("="), trace_id), F.lit(""))


def _save(df: DataFrame, table: str, buckets: int, key: str, order: list[str], path: str | None) -> None:
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key, *order).mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def save_span_store(spans: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """Spans with their attributes as a table bucketed by trace, in order of time within it."""
    keyed = with_attributes(spans).withColumn(TRACE_KEY, trace_key(F.col("trace_id")))
    _save(keyed, table, buckets, TRACE_KEY, ["timestamp", "span_id"], path)


def save_run_store(resolved: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """Resolved dependencies as a table bucketed by run, in their order within it."""
    _save(resolved, table, buckets, "run_id", ["ts", "id", "row_id"], path)


def stored_fill(spark: SparkSession, table: str, columns: tuple[str, ...] = ("user_id", "thread_id")) -> DataFrame:
    """``fill_over_trace`` of a span store: the aggregate and the join stay inside the buckets."""
    spans = spark.table(table)
    position = F.struct("timestamp", "span_id")
    firsts = spans.groupBy(TRACE_KEY).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), position)).alias(f"{c}_filled") for c in columns]
    )
    return spans.join(firsts.hint("merge"), TRACE_KEY).drop(TRACE_KEY)


def stored_run_attributes(spark: SparkSession, table: str) -> DataFrame:
    """``run_attributes`` of a run store, without an exchange."""
    return run_attributes(spark.table(table))
