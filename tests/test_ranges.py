"""Large files read in ranges give what whole reads give."""

from __future__ import annotations

import json
import random

import pytest

from spanloom.sources import ranges
from spanloom.sources.export import read_export, read_export_rejects, undeclared_columns
from spanloom.sources.tables import CSV_OPTIONS, read_csv


@pytest.fixture(params=[1 << 20, 300])
def range_bytes(spark, request):
    """Ranges of so many bytes, down to less than a record."""
    confs = {"spark.sql.files.maxPartitionBytes": str(request.param), "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


CELLS = ["plain", "", None, 'with "quotes"', "two\nlines", "comma, comma", "[1,2]", "]]", '"', "é漢𝒳", "back\\slash", "\\", '\\"]', "line\r\nend", " padded "]


def document(seed, n, keys_first="columns", indent=None, cells=CELLS):
    rng = random.Random(seed)
    names = ["Id", "Name", "Properties", "DurationMs", "Success", "Unknown", "TimeGeneratedUTCMinus5"]
    nested = [{"k": [1, {"x": "]"}], "rows": [[1], []]}, [[], ["a", [1]]], {}, [], 1.5, True, False, None]
    rows = [[f"id{i}", rng.choice(cells), rng.choice(nested), rng.choice(nested), rng.choice(cells), rng.choice(cells), "2024-01-02T03"] for i in range(n)]
    columns = [{"name": c, "type": "string"} for c in names]
    table = {"name": 'Primary "]', "columns": columns, "rows": rows} if keys_first == "columns" else {"rows": rows, "columns": columns}
    other = {"name": "second", "columns": [{"name": "Id"}], "rows": [["other"], ["other2"]]}
    more = {"statistics": [1, [2, [3]]], "note": "[["} if keys_first != "columns" else {}
    return json.dumps(more | {"tables": [table, other]} | {"after": [[["x"]]]}, indent=indent, ensure_ascii=seed % 2 == 0)


def rows_of(df):
    return sorted(map(tuple, df.select("Id", "Name", "Properties", "DurationMs", "Success", "date_routine").collect()), key=str)


def test_large_exports_equal_whole_ones(spark, tmp_path, range_bytes):
    texts = {"a": document(1, 12), "b": document(2, 8, "rows"), "c": document(3, 5, indent=2), "d": "﻿" + document(4, 0), "e": document(5, 3)}
    for name, text in texts.items():
        (tmp_path / f"{name} file.json").write_bytes(text.encode())
    whole = rows_of(read_export(spark, str(tmp_path), "app_requests"))
    assert len(whole) == 28
    assert rows_of(read_export(spark, str(tmp_path), "app_requests", large=0)) == whole
    assert rows_of(read_export(spark, str(tmp_path), "app_requests", large=1200)) == whole  # some of both kinds
    assert [tuple(r) for r in undeclared_columns(spark, str(tmp_path), "app_requests", large=0).collect()] == [("Unknown", 28)]


def test_bad_large_exports_fail_as_whole_ones(spark, tmp_path):
    good = {"columns": [{"name": "Id"}], "rows": [["1"], ["short", "no"]]}
    (tmp_path / "a.json").write_text(json.dumps({"tables": [good]}))
    assert [r.row for r in read_export_rejects(spark, str(tmp_path), "app_requests", large=0).collect()] == [["short", "no"]]
    with pytest.raises(Exception, match="another width"):
        read_export(spark, str(tmp_path), "app_requests", large=0).collect()
    for i, text in enumerate(['{"tables":[', '{"tables":[{"columns":[{"name":"Id"}],"rows":[["1"],["2"', '{"error":{"code":"Busy"}}', '{"tables":[]}', '{"tables":[{"columns":[],"rows":[]}]']):
        path = tmp_path / f"bad{i}"
        path.mkdir()
        (path / "x.json").write_text(text)
        with pytest.raises(Exception, match="malformed|without a table"):
            read_export(spark, str(path), "app_requests", large=0).collect()


def csv_text(seed, n, end="\n"):
    rng = random.Random(seed)
    quote = lambda c: "" if c is None else '"' + c.replace('"', '""') + '"' if rng.random() < 0.3 or any(x in c for x in '",\r\n') else c
    lines = ["Id,Message,TimeGenerated,Properties"]
    for i in range(n):
        lines.append(",".join(quote(c) for c in [f"id{i}", rng.choice(CELLS), "2024-01-02T00:00:00Z", rng.choice([json.dumps({"a": rng.choice(CELLS)}), *CELLS])]))
        if rng.random() < 0.1:
            lines.append("")
    return end.join(lines)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_large_csv_equals_whole(spark, tmp_path, range_bytes, end):
    for name, n in (("a", 40), ("b", 7), ("c", 0)):
        (tmp_path / f"{name}.csv").write_bytes((csv_text(ord(name), n, end) + (end if name == "a" else "")).encode())
    take = lambda **size: sorted(map(tuple, read_csv(spark, str(tmp_path), "app_traces", **size).select("Message", "TimeGenerated", "Properties").collect()), key=str)
    whole = take()
    assert len(whole) == 47
    assert take(large=0) == whole and take(large=400) == whole


def test_one_csv_file_is_read_by_many_tasks(spark, tmp_path, range_bytes):
    (tmp_path / "a.csv").write_bytes(csv_text(1, 200).replace("\n\n", "\n").encode())
    cut = ranges.cut_records(spark, [str(tmp_path / "a.csv")], ranges.Csv)
    starts = cut.select("start").distinct().count()
    size = (tmp_path / "a.csv").stat().st_size
    assert starts >= max(2, size // range_bytes // 2) and cut.count() == 201


def test_stray_quotes_and_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Id,Message\n1,say "hi" now\n')
    with pytest.raises(ValueError, match="quotes inside"):
        read_csv(spark, str(tmp_path), "app_traces", large=0)
    assert read_csv(spark, str(tmp_path), "app_traces").first().Message == 'say "hi" now'
    (tmp_path / "a.csv").write_text("Id,Message\n1,m\n")
    (tmp_path / "b.csv").write_text("Message,Id\nm,1\n")
    with pytest.raises(Exception, match="does not conform"):
        read_csv(spark, str(tmp_path), "app_traces", large=0).collect()
    assert CSV_OPTIONS["multiLine"] == "true"
