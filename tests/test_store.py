"""Bucketed stores give the same reports without exchanges."""

from __future__ import annotations

import pytest

from spanloom.catalog import Workspace
from spanloom.plans import runs as U, spans as S
from spanloom.plans.store import save_run_store, save_span_store, stored_fill, stored_run_attributes


@pytest.fixture(scope="module")
def workspace(spark):
    return Workspace(spark, "/root/testdata/sf0.001")


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_fill_stays_in_the_buckets(spark, workspace, tmp_path):
    hole = workspace.spans.limit(50).selectExpr("* except (trace_id)", "cast(null as string) as trace_id").select(workspace.spans.columns)
    spans = workspace.spans.unionByName(hole)
    save_span_store(spans, "span_store_test", 6, str(tmp_path / "s"))
    filled = stored_fill(spark, "span_store_test")
    assert "Exchange" not in plan(filled)
    columns = ["span_id", "trace_id", "user_id_filled", "thread_id_filled", "tool_name", "timestamp"]
    wanted = S.fill_over_trace(S.with_attributes(spans)).select(columns)
    assert sorted(map(str, filled.select(columns).collect())) == sorted(map(str, wanted.collect()))
    spark.sql("DROP TABLE span_store_test")


def test_run_attributes_stay_in_the_buckets(spark, workspace, tmp_path):
    resolved = workspace.skeleton.resolved
    save_run_store(resolved, "run_store_test", 6, str(tmp_path / "r"))
    found = stored_run_attributes(spark, "run_store_test")
    assert "Exchange" not in plan(found)
    assert sorted(found.collect()) == sorted(U.run_attributes(resolved).collect())
    spark.sql("DROP TABLE run_store_test")
