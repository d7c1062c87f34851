"""CSV and catalog sources for bronze tables, and a profile of what was loaded."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.staging import stage
from ..schemas import BRONZE_COLUMNS, PARTITION_COLUMN, bronze_schema
from .export import with_partition_date
from .ranges import LARGE, Csv, cut_records, file_sizes, large_files
from .telemetry import conform

# How the CSV exports are written.
# With several files in a folder, one whose header differs from the first fails the read.
CSV_OPTIONS = {"header": "true", "enforceSchema": "false", "inferSchema": "false", "multiLine": "true", "quote": '"', "escape": '"'}
CSV_FILES = {table: f"{table}.csv" for table in BRONZE_COLUMNS}


def _csv_in_ranges(spark: SparkSession, paths: list[str], header: DataFrame) -> DataFrame:
    """Rows of large CSV files, whose records are found by many tasks; each file must have the columns of ``header``."""
    names = header.columns
    options = {k: v for k, v in CSV_OPTIONS.items() if k in ("quote", "escape", "multiLine")}
    first = (F.col("start") == 0) & (F.col("n") == 0)
    found = cut_records(spark, paths, Csv)
    # A file whose first line ends in two characters has them made one everywhere, as in a whole read.
    breaks = stage(found.filter(first).select("file", F.col("text").endswith("\r\n").alias("paired")), "csv-line-breaks")
    text = F.when(F.col("paired"), F.replace("text", F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("text"))
    text = F.regexp_replace(F.regexp_replace(text, r"\n\z", ""), "^﻿", "")
    records = found.join(breaks, "file").select("start", "n", text.alias("text")).filter(F.col("text") != "")
    cells = F.from_csv("text", ", ".join(f"`{c}` string" for c in names), options)
    same = F.array(*[cells.getField(c) for c in names]) == F.array(*[F.lit(c) for c in names])
    refused = F.raise_error(F.concat(F.lit("CSV header does not conform to the first file's: "), F.col("text"))).cast("boolean")
    return records.filter(F.when(first, F.when(same, F.lit(False)).otherwise(refused)).otherwise(F.lit(True))).select(cells.alias("c")).select("c.*")


def read_csv(spark: SparkSession, path: str, table: str, large: int = LARGE) -> DataFrame:
    """Bronze rows from CSV, columns by header name. A missing file gives the empty table.

    Files of one folder must have one header: a file with other columns or another order fails. Files
    above ``large`` bytes are read in ranges, by many tasks.
    """
    try:
        rows = spark.read.options(**CSV_OPTIONS).csv(path)
        cut = large_files(file_sizes(spark, path), large)
        if cut:
            small = [r["path"] for r in file_sizes(spark, path).filter(F.col("length") <= large).select("path").collect()]
            ranged = _csv_in_ranges(spark, cut, rows)
            rows = spark.read.options(**CSV_OPTIONS).csv(small).unionByName(ranged) if small else ranged
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], bronze_schema(table))
    if PARTITION_COLUMN not in rows.columns and "TimeGeneratedUTCMinus5" in rows.columns:
        rows = with_partition_date(rows)
    return conform(rows, table)


def read_csv_folder(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {table: read_csv(spark, f"{folder.rstrip('/')}/{name}", table) for table, name in CSV_FILES.items()}


def read_tables(
    spark: SparkSession, names: Mapping[str, str], first_day: str | None = None, last_day: str | None = None
) -> dict[str, DataFrame]:
    """Bronze tables from the catalog: ``{table: catalog name}``, pruned to a range of days."""
    found = {}
    for table, name in names.items():
        df = spark.table(name)
        if first_day:
            df = df.filter(F.col(PARTITION_COLUMN) >= first_day)
        if last_day:
            df = df.filter(F.col(PARTITION_COLUMN) <= last_day)
        found[table] = df
    return found


def profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, columns and schema (names and types in order) per table."""
    report = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count"),
            F.lit(", ".join(f"{c} {kind}" for c, kind in df.dtypes)).alias("columns"),
        )
        report = row if report is None else report.unionByName(row)
    return report
