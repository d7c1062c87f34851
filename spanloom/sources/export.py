"""JSON exports of a log workspace: ``{"tables":[{"columns":[{"name":..}],"rows":[[..],..]}]}``.

Documents up to ``LARGE`` bytes are parsed whole, one task a file. A larger one is cut into its rows by many
tasks (see ``ranges``), so it may be longer than a string can be; its header is parsed from what is
left when the rows are taken out.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.scalars import JSON_LIMITS
from ..operators.lookup import lookup
from ..operators.staging import stage
from ..schemas import PARTITION_COLUMN, bronze_schema, export_columns
from .ranges import LARGE, Json, cut_records, file_sizes, large_files

_TABLE = "struct<columns:array<struct<name:string>>,rows:array<array<string>>>"
_DOCUMENT = f"tables array<{_TABLE}>"


def _sizes(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lengths of the files. A file without a byte gives no row, so it would be missed: it is refused here."""
    sizes = file_sizes(spark, paths)
    listed, read = len(sizes.inputFiles()), sizes.count()
    if read < listed:
        raise ValueError(f"{listed - read} of {listed} are empty export files")
    return sizes


def _whole_documents(documents: DataFrame) -> DataFrame:
    """Column names and rows of the first table of each document text."""
    text = F.regexp_replace("value", "^﻿", "")
    parsed = F.from_json(text, _DOCUMENT, JSON_LIMITS | {"mode": "FAILFAST"})
    table_one = F.try_element_at(parsed["tables"], F.lit(1))
    first = F.when(table_one["columns"].isNotNull(), table_one).otherwise(
        F.raise_error(F.concat(F.lit("export document without a table: "), F.coalesce(F.substring(text, 1, 200), F.lit("")))).cast(_TABLE)
    )
    return (
        documents.select(first.alias("t"))
        .select(F.transform("t.columns", lambda c: c["name"]).alias("names"), F.col("t.rows").alias("rows"))
        .select("names", F.explode("rows").alias("row"))
    )


_HEADER = "file string, names array<string>, first struct<start:bigint,n:bigint>, last struct<start:bigint,n:bigint>, row string"
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[\[\]]', re.DOTALL)


def _first_row(text: str, depth: int) -> int:
    """Where in ``text`` an array of arrays begins its first element, or -1; strings are passed over."""
    for token in _TOKEN.finditer(text):
        if token[0] == "[":
            depth += 1
            if depth == 3:
                return token.start() if text[: token.start()].rstrip().endswith("[") else -1
        elif token[0] == "]":
            depth -= 1
    return -1


def _header(records: pd.DataFrame) -> pd.DataFrame:
    """Names of the first table of one document, and where its rows begin and end, from all records that are not rows.

    The document without its rows is a JSON value of its own; in it each list of rows is given by its number.
    """
    skeleton, lists = [], []
    for r in records.sort_values(["start", "n"]).itertuples():
        at = _first_row(r.text, r.depth) if r.depth < 2 else -1
        if at >= 0:
            skeleton.append(f"{r.text[:at]}{len(lists)}")
            lists.append([(r.start, r.n), None, r.text[at:]])
        else:
            if r.depth == 2 and r.text.strip() == "]" and lists and lists[-1][1] is None:
                lists[-1][1] = (r.start, r.n)
            skeleton.append(r.text)
    text = "".join(skeleton).removeprefix("\ufeff")
    try:
        # The last separator is made up: nothing follows the last brace.
        document = json.loads(text[:-1])
    except ValueError as error:
        raise ValueError(f"malformed export document: {records['file'].iloc[0]}: {error}") from None
    tables = document.get("tables") if isinstance(document, dict) else None
    if not (isinstance(tables, list) and tables and isinstance(tables[0], dict) and isinstance(tables[0].get("columns"), list)):
        raise ValueError(f"export document without a table: {text[:200]}")
    names = [c.get("name") if isinstance(c, dict) else None for c in tables[0]["columns"]]
    first = last = row = None
    for number in tables[0].get("rows") or []:
        first, last, row = lists[number]
    place = lambda p: None if p is None else {"start": p[0], "n": p[1]}
    return pd.DataFrame({"file": [records["file"].iloc[0]], "names": [names], "first": [place(first)], "last": [place(last)], "row": [row]})


def _large_documents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """As ``_whole_documents``, for documents that are read in ranges."""
    records = cut_records(spark, paths, Json).withColumn("body", F.regexp_replace("text", r"^[\s,]+", ""))
    is_row = (F.col("depth") == 2) & F.col("body").startswith("[")
    headers = stage(records.filter(~is_row).drop("body").groupBy("file").applyInPandas(_header, _HEADER), "export-headers")
    place = F.struct("start", "n")
    inside = lookup(records.filter(is_row), headers.select("file", "names", "first", "last"), ["file"], "inner").filter(
        (place > F.col("first")) & (F.col("last").isNull() | (place < F.col("last")))
    )
    texts = inside.select("names", F.col("body").alias("text")).unionByName(
        headers.filter(F.col("row").isNotNull()).select("names", F.col("row").alias("text"))
    )
    return texts.select("names", F.from_json("text", "array<string>", JSON_LIMITS | {"mode": "FAILFAST"}).alias("row"))


def _rows(spark: SparkSession, paths: str | list[str], table: str, large: int) -> DataFrame:
    """Rows of the first table of each document, with the place of each declared column."""
    sizes = _sizes(spark, paths)
    cut = large_files(sizes, large)
    documents = spark.read.text(paths, wholetext=True)
    if cut:
        small = spark.read.format("binaryFile").load(paths).filter(F.col("length") <= large)
        documents = small.select(F.decode("content", "UTF-8").alias("value"))
    found = _whole_documents(documents)
    if cut:
        found = found.unionByName(_large_documents(spark, cut))
    return _placed(found, table)


def _placed(rows: DataFrame, table: str) -> DataFrame:
    # header order may differ per file: each row comes with the places of its document's header
    place = F.struct(*[F.array_position("names", F.lit(c)).cast("int").alias(c) for c in export_columns(table)])
    return rows.select("names", F.size("names").alias("width"), place.alias("place"), "row")


def _cell(column: str) -> Column:
    at = F.col("place").getField(column)
    return F.when(at > 0, F.get("row", at - 1)).alias(column)


def with_partition_date(df: DataFrame) -> DataFrame:
    """Add the partition date: the day part of the local time of the row."""
    return df.withColumn(PARTITION_COLUMN, F.substring("TimeGeneratedUTCMinus5", 1, 10))


def read_export(spark: SparkSession, paths: str | list[str], table: str, short_rows: str = "fail", large: int = LARGE) -> DataFrame:
    """Bronze rows from export files: all strings, declared columns by name, absent ones NULL.

    A malformed document, one without a table, an empty file and a row of another width than its
    header fail the read; with ``short_rows="drop"`` such rows are left out, and ``read_export_rejects``
    returns them. ``undeclared_columns`` lists the columns of the documents that the table has not.
    Documents above ``large`` bytes are read in ranges.
    """
    return _cells(_rows(spark, paths, table, large), table, short_rows)


def document_rows(documents: DataFrame, table: str, short_rows: str = "fail") -> DataFrame:
    """Bronze rows of whole document texts (``value``), as ``read_export`` gives them; a stream will do."""
    return _cells(_placed(_whole_documents(documents), table), table, short_rows)


def _cells(rows: DataFrame, table: str, short_rows: str) -> DataFrame:
    fits = F.size("row") == F.col("width")
    if short_rows == "drop":
        rows = rows.filter(fits)
    else:
        told = F.raise_error(F.concat(F.lit("row of another width than its header: "), F.to_json("row"))).cast("array<string>")
        rows = rows.withColumn("row", F.when(fits, F.col("row")).otherwise(told))
    cells = rows.select(*[_cell(c) for c in export_columns(table)])
    return with_partition_date(cells).select(bronze_schema(table).names)


def read_export_rejects(spark: SparkSession, paths: str | list[str], table: str, large: int = LARGE) -> DataFrame:
    return _rows(spark, paths, table, large).filter(F.size("row") != F.col("width")).select("row", "width")


def undeclared_columns(spark: SparkSession, paths: str | list[str], table: str, large: int = LARGE) -> DataFrame:
    """Columns of the documents that ``table`` does not declare, with the number of rows that have them."""
    found = _rows(spark, paths, table, large).select(F.explode("names").alias("column")).groupBy("column").agg(F.count(F.lit(1)).alias("rows"))
    return found.filter(~F.col("column").isin(export_columns(table)))
