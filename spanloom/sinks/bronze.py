"""Bronze tables: create, overwrite, purge."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.scalars import parse_ts
from ..operators.staging import stage
from ..schemas import BRONZE_COLUMNS, PARTITION_COLUMN, bronze_ddl


def create_bronze(spark: SparkSession, schema: str, fmt: str = "parquet", location: str | None = None) -> None:
    """Create the schema and the three tables where they do not exist."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    for table in BRONZE_COLUMNS:
        place = f"{location.rstrip('/')}/{table}" if location else None
        spark.sql(bronze_ddl(table, f"{schema}.{table}", fmt, place))


_MODE_LOCK = threading.Lock()


@contextmanager
def _partition_mode(spark: SparkSession, mode: str) -> Iterator[None]:
    """``insertInto`` takes its partition overwrite mode from the session; put the old one back.

    Only one such write runs at a time, so none sees the mode of another.
    """
    key = "spark.sql.sources.partitionOverwriteMode"
    with _MODE_LOCK:
        before = spark.conf.get(key)
        spark.conf.set(key, mode)
        try:
            yield
        finally:
            spark.conf.set(key, before)


def _insert_overwrite(df: DataFrame, table: str, mode: str) -> None:
    with _partition_mode(df.sparkSession, mode):
        df.write.mode("overwrite").insertInto(table)


def overwrite_bronze(df: DataFrame, table: str | None = None, path: str | None = None, fmt: str = "parquet") -> None:
    """Replace all rows of a table, or of a folder, partitioned by date.

    A table that exists keeps its definition and place. The rebalance hint sizes files by bytes:
    a small date becomes one file, and a date with a large share of the rows is split over as
    many tasks as it needs.
    """
    spark = df.sparkSession
    sized = df.hint("rebalance", PARTITION_COLUMN)
    if table and spark.catalog.tableExists(table):
        _insert_overwrite(sized.select(spark.table(table).columns), table, "static")
        return
    writer = sized.write.format(fmt).mode("overwrite").partitionBy(PARTITION_COLUMN)
    if table:
        (writer.option("path", path) if path else writer).saveAsTable(table)
    else:
        writer.option("partitionOverwriteMode", "static").save(path)


def readable_cutoff(spark: SparkSession, cutoff: str) -> Column:
    """``cutoff`` as a timestamp literal."""
    micros = spark.range(1).select(F.unix_micros(parse_ts(F.lit(cutoff)))).first()[0]
    if micros is None:
        raise ValueError(f"cutoff is not a time: {cutoff!r}")
    return F.timestamp_micros(F.lit(micros))


def retained(df: DataFrame, cutoff: str) -> DataFrame:
    """Rows not older than ``cutoff`` (ISO text). Rows without a readable time are kept; an unreadable cutoff raises."""
    at, limit = parse_ts(F.col("TimeGenerated")), readable_cutoff(df.sparkSession, cutoff)
    return df.filter(at.isNull() | (at >= limit))


def _empty_partition(spark: SparkSession, table: str, columns: list[str], day: str | None) -> None:
    """Delete one partition: its files first, which a mere drop would leave in an external table."""
    spec = "null" if day is None else "'" + day.replace("\\", "\\\\").replace("'", "\\'") + "'"
    nothing = ", ".join("null" for c in columns if c != PARTITION_COLUMN)
    with _partition_mode(spark, "static"):
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({PARTITION_COLUMN}={spec}) SELECT {nothing} WHERE false")
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({PARTITION_COLUMN}={spec})")


def _delete_rows(spark: SparkSession, table: str, limit: Column) -> None:
    """``DELETE`` by the rule of ``retained``: the distinct stale time texts, as a subquery."""
    stale = spark.table(table).select("TimeGenerated").distinct().filter(parse_ts(F.col("TimeGenerated")) < limit)
    view = f"stale_{uuid.uuid4().hex}"
    stale.createOrReplaceTempView(view)
    try:
        spark.sql(f"DELETE FROM {table} WHERE TimeGenerated IN (SELECT TimeGenerated FROM {view})")
    finally:
        spark.catalog.dropTempView(view)


def purge(spark: SparkSession, tables: Iterable[str], cutoff: str, fmt: str = "parquet") -> None:
    """Delete rows older than ``cutoff`` from catalog tables.

    Only the dates that hold such rows are rewritten, from a staged copy of what they keep;
    dates that keep nothing are emptied. The list of dates is bounded by the calendar. A run
    that breaks off can be repeated.
    """
    limit = readable_cutoff(spark, cutoff)
    for table in tables:
        if fmt == "delta":
            _delete_rows(spark, table, limit)
            continue
        rows = spark.table(table)
        at = parse_ts(F.col("TimeGenerated"))
        stale = rows.filter(at < limit).select(PARTITION_COLUMN).distinct()
        days = [r[0] for r in stale.collect()]
        if not days:
            continue
        named = [d for d in days if d is not None]
        touched = F.col(PARTITION_COLUMN).isin(named)
        if None in days:
            touched = touched | F.col(PARTITION_COLUMN).isNull()
        kept = stage(retained(rows.filter(touched), cutoff), "retained")
        full = {r[0] for r in kept.select(PARTITION_COLUMN).distinct().collect()}
        if full:
            _insert_overwrite(kept.select(rows.columns).hint("rebalance", PARTITION_COLUMN), table, "dynamic")
        for day in days:
            if day not in full:
                _empty_partition(spark, table, rows.columns, day)
        spark.catalog.refreshTable(table)
