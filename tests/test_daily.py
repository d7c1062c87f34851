"""Reports merged from the states of days equal full ones, and a new day is all that is read."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from spanloom.catalog import Workspace
from spanloom.plans import reports as R, runs as U, spans as S
from spanloom.plans.daily import SOURCES, DailyStates, states as all_states
from spanloom.schemas import PARTITION_COLUMN, bronze_schema
from spanloom.streaming.exports import load_new_exports


@pytest.fixture(scope="module")
def workspace(spark):
    return Workspace(spark, "/root/testdata/sf0.001")


def append(df, path):
    df.write.mode("append").partitionBy(PARTITION_COLUMN).parquet(path)


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect()))


def test_adding_a_day_equals_a_rebuild(spark, workspace, tmp_path, monkeypatch):
    bronze = {source: str(tmp_path / source) for source in SOURCES}
    states = DailyStates(spark, str(tmp_path / "states"))
    last = "2024-01-20"
    for source, path in bronze.items():
        append(workspace.bronze[source].filter(F.col(PARTITION_COLUMN) < last), path)
    states.add(bronze)
    for source, path in bronze.items():
        append(workspace.bronze[source].filter(F.col(PARTITION_COLUMN) == last), path)
    # a call that breaks off before its files are listed does not count
    with monkeypatch.context() as m:
        m.setattr(spark, "createDataFrame", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            states.add(bronze)
    read = states.add(bronze)
    assert read and all(f"{PARTITION_COLUMN}={last}" in f for f in read) and states.add(bronze) == []
    rows = {s: workspace.bronze[s].filter(F.col(PARTITION_COLUMN) <= last) for s in SOURCES}
    spans = S.union_spans(rows["app_requests"], rows["app_dependencies"])
    chat = U.chat_requests(rows["app_requests"])
    full = {
        "users_active": R.users_active(spans), "threads_summary": R.threads_summary(spans), "thread_owner": U.thread_owner(chat),
        "run_first": U.run_first(chat), "op_run_map": U.operation_runs(U.parse_dependencies(rows["app_dependencies"])),
    }
    assert set(full) == set(all_states())
    for name, wanted in full.items():
        assert same(states.report(name), wanted), name
    with pytest.raises(ValueError, match="nothing was added"):
        DailyStates(spark, str(tmp_path / "other")).report("run_first")


def test_stream_takes_what_is_new(spark, tmp_path):
    source, target, memory = tmp_path / "in", tmp_path / "out", tmp_path / "memory"
    source.mkdir()

    def put(name, ids):
        doc = {"tables": [{"columns": [{"name": "Id"}, {"name": "TimeGeneratedUTCMinus5"}], "rows": [[i, "2024-01-02T00"] for i in ids]}]}
        (source / name).write_text(json.dumps(doc))

    def load():
        load_new_exports(spark, str(source), str(target), str(memory), "app_requests", files_at_once=1)
        rows = spark.read.schema(bronze_schema("app_requests")).parquet(str(target)).collect()
        assert {r.date_routine for r in rows} == {"2024-01-02"}
        return sorted(r.Id for r in rows)

    put("a.json", "ab")
    put("b.json", "c")
    assert load() == ["a", "b", "c"] == load()
    put("c.json", "de")
    assert load() == list("abcde")
    (source / "d.json").write_text('{"error":1}')
    with pytest.raises(Exception, match="without a table"):
        load()
