from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from spanloom.operators.staging import stage, temporary_stages
from spanloom.schemas import BRONZE_COLUMNS, bronze_schema
from spanloom.sinks.bronze import create_bronze, overwrite_bronze, purge, retained
from spanloom.sources.export import read_export, read_export_rejects, undeclared_columns
from spanloom.sources.tables import profile, read_csv, read_csv_folder, read_tables


def _export(path, columns, rows, bom=False):
    doc = {"tables": [{"name": "t", "columns": [{"name": c} for c in columns], "rows": rows}]}
    path.write_text(("﻿" if bom else "") + json.dumps(doc), encoding="utf-8")


def test_column_counts():
    assert {t: len(c) for t, c in BRONZE_COLUMNS.items()} == {"app_requests": 43, "app_traces": 36, "app_dependencies": 43}


def test_export(spark, tmp_path):
    _export(tmp_path / "a.json", ["Id", "Success", "DurationMs", "TimeGeneratedUTCMinus5", "Properties"],
            [["1", True, 1.5, "2024-01-02T03:00:00", {"k": 1}], ["2", None, 2, "2024-01-03T03:00:00", None], ["short"]], bom=True)
    _export(tmp_path / "b.json", ["DurationMs", "Id", "Unknown"], [[3, "3", "x"]])
    with pytest.raises(Exception, match="another width"):
        read_export(spark, str(tmp_path), "app_requests").collect()
    assert [tuple(r) for r in undeclared_columns(spark, str(tmp_path), "app_requests").collect()] == [("Unknown", 1)]
    rows = read_export(spark, str(tmp_path), "app_requests", short_rows="drop")
    assert rows.schema == bronze_schema("app_requests")
    got = sorted(tuple(r) for r in rows.select("Id", "Success", "DurationMs", "Properties", "date_routine").collect())
    assert got == [("1", "true", "1.5", '{"k":1}', "2024-01-02"), ("2", None, "2", None, "2024-01-03"), ("3", None, "3", None, None)]
    assert [r.row for r in read_export_rejects(spark, str(tmp_path), "app_requests").collect()] == [["short"]]


def test_broken_export_fails(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"tables":[')
    with pytest.raises(Exception):
        read_export(spark, str(tmp_path), "app_requests").collect()


@pytest.mark.parametrize("text", ['{"error":{"code":"Busy"}}', "{}", ""])
def test_export_without_a_table_fails(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="without a table|empty export"):
        read_export(spark, str(tmp_path), "app_requests").collect()


def test_csv_with_other_headers_fails(spark, tmp_path):
    for name, text in (("a.csv", "Id,Name\n1,n1\n"), ("b.csv", "Name,Id\nn2,2\n")):
        (tmp_path / name).write_text(text)
    with pytest.raises(Exception):
        read_csv(spark, str(tmp_path), "app_requests").collect()


def test_unreadable_cutoff_fails(spark):
    rows = spark.createDataFrame([("2024-01-01T00:00:00Z",)], "TimeGenerated string")
    assert retained(rows, "2024-01-01T00:00").count() == 1
    with pytest.raises(ValueError, match="not a time"):
        retained(rows, "yesterday")
    with pytest.raises(ValueError, match="not a time"):
        purge(spark, ["nowhere"], "yesterday")


def test_temporary_stages(spark):
    with temporary_stages(spark):
        path = stage(spark.range(3), "t").inputFiles()[0].removeprefix("file://").removeprefix("file:")
        assert os.path.exists(path)
    assert not os.path.exists(os.path.dirname(path))


def test_csv(spark, tmp_path):
    (tmp_path / "app_traces.csv").write_text(
        'Message,TimeGenerated,Properties,TimeGeneratedUTCMinus5\n'
        'm,2024-01-02T00:00:00Z,"{""a"":""x\ny""}",2024-01-01T19:00:00\n,2024-01-02T00:00:01Z,"",\n'
    )
    tables = read_csv_folder(spark, str(tmp_path))
    rows = tables["app_traces"].orderBy("TimeGenerated").collect()
    assert [(r.Message, r.Properties, r.date_routine) for r in rows] == [("m", '{"a":"x\ny"}', "2024-01-01"), (None, None, None)]
    assert tables["app_requests"].schema == bronze_schema("app_requests")
    assert tables["app_requests"].count() == 0
    assert read_csv(spark, str(tmp_path / "none.csv"), "app_dependencies").count() == 0


def test_tables_overwrite_and_purge(spark, tmp_path):
    create_bronze(spark, "bronze_test", location=str(tmp_path))
    create_bronze(spark, "bronze_test", location=str(tmp_path))
    name = "bronze_test.app_requests"
    assert spark.table(name).columns == BRONZE_COLUMNS["app_requests"]
    times = ["2024-01-01T10:00:00Z", "2024-01-02T10:00:00Z", "2024-01-02T20:00:00Z", "unknown", "2024-01-03T00:00:00Z", "2024-01-01T00:00:00Z"]
    days = ["2024-01-01", "2024-01-02", "2024-01-02", "2024-01-02", "2024-01-03", None]
    rows = spark.createDataFrame(list(zip("abcdef", times, days)), "Id string, TimeGenerated string, date_routine string")
    full = rows.select(*[(F.col(c) if c in rows.columns else F.lit(None).cast("string")).alias(c) for c in BRONZE_COLUMNS["app_requests"]])
    for _ in range(2):
        overwrite_bronze(full, table=name)
    found = lambda: sorted(r.Id for r in spark.table(name).collect())
    assert found() == list("abcdef")
    pruned = read_tables(spark, {"app_requests": name}, first_day="2024-01-02", last_day="2024-01-02")["app_requests"]
    assert sorted(r.Id for r in pruned.collect()) == list("bcd")
    assert [tuple(r) for r in profile({"app_requests": spark.table(name)}).collect()] [0][:3] == ("app_requests", 6, 43)
    for _ in range(2):
        purge(spark, [name], "2024-01-02T12:00:00Z")
        assert found() == list("cde")
    partitions = sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect())
    assert partitions == ["date_routine=2024-01-02", "date_routine=2024-01-03"]
    folders = sorted(p.name for p in (tmp_path / "app_requests").iterdir() if any(p.glob("*.parquet")))
    assert folders == partitions  # an external table: its files are gone too
    spark.sql("DROP SCHEMA bronze_test CASCADE")
