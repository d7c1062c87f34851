"""Spans, attributes, trace fill and the reports over them, on hand-written rows."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from spanloom.plans import reports as R, spans as S
from spanloom.schemas import bronze_schema
from spanloom.sources.telemetry import conform


def bronze(spark, table, rows):
    columns = sorted({c for r in rows for c in r})
    schema = ", ".join(f"`{c}` string" for c in columns) or "Id string"
    data = [tuple(json.dumps(v) if isinstance(v, dict) else v for v in (r.get(c) for c in columns)) for r in rows]
    return conform(spark.createDataFrame(data, schema), table)


def at(second: int) -> str:
    return f"2024-01-01T00:00:{second:02d}Z"


def test_span_shapes(spark):
    requests = bronze(spark, "app_requests", [
        dict(TimeGenerated=at(1), Id="r1", OperationId="o", Name="POST /chat", DurationMs="", Success="True",
             Properties={"user.id": "u", "thread.id": "t2", "azure.thread_id": "t3", "tokens.total": "12"}),
        dict(TimeGenerated="bad", Id="r2", Name="GET /chat/x", DurationMs="1.5",
             Properties={"gen_ai.thread.id": "t1", "thread.id": "t2", "gen_ai.usage.total_tokens": "x", "tokens.total": "5"}),
    ])
    dependencies = bronze(spark, "app_dependencies", [
        dict(TimeGenerated=at(2), Id="d1", OperationId="o", Name="tool.x", DependencyType="InProc", Properties="{bad")])
    assert requests.schema == bronze_schema("app_requests")
    rows = {r.span_id: r for r in S.build_spans(requests, dependencies).collect()}
    assert (rows["r1"].kind, rows["d1"].kind) == ("SERVER", "InProc")
    assert (rows["r1"].thread_id, rows["r2"].thread_id, rows["d1"].thread_id) == ("t2", "t1", None)
    # the cast comes after the choice: a bad first token text hides a good second one
    assert (rows["r1"].tokens_total, rows["r2"].tokens_total) == (12, None)
    assert (rows["r1"].duration_ms, rows["r2"].timestamp) == (None, None)
    spans = S.union_spans(requests, dependencies)
    assert [tuple(r) for r in R.users_active(spans).collect()] == [("u", 1)]
    threads = R.threads_summary(spans).select("thread_id", "interacciones", "tokens_consumidos").collect()
    assert [tuple(r) for r in threads] == [("t2", 1, 12), ("t1", 0, None)]
    assert [r.name for r in R.tool_calls(spans).collect()] == ["tool.x"]


def test_fill_over_trace(spark):
    def span(i, trace, second, user=None):
        return dict(TimeGenerated=at(second), Id=i, OperationId=trace, Properties={"user.id": user} if user else None)

    requests = bronze(spark, "app_requests", [
        span("a1", "a", 1), span("a2", "a", 2, "u1"), span("a3", "a", 3, "u2"), span("b1", "b", 1),
        span("c2", "c", 1, "second"), span("c1", "c", 1, "first"), span("n1", None, 1), span("n2", None, 2, "un"),
    ])
    spans = S.build_spans(requests, bronze(spark, "app_dependencies", []))
    got = {r.span_id: r.user_id_filled for r in S.fill_over_trace(spans).collect()}
    assert got == {"a1": "u1", "a2": "u1", "a3": "u1", "b1": None, "c1": "first", "c2": "first", "n1": "un", "n2": "un"}


def test_reports_are_newest_first(spark):
    requests = bronze(spark, "app_requests", [
        dict(TimeGenerated=at(i), Id=str(i), Name="POST /chat", Properties={"user.id": str(i)}) for i in (3, 1, 2)])
    spans = S.union_spans(requests, bronze(spark, "app_dependencies", []))
    assert [r.user_id for r in R.interactions(spans).collect()] == ["3", "2", "1"]
    traces = bronze(spark, "app_traces", [
        dict(TimeGenerated=at(1), Message=json.dumps({"log_type": "audit.business", "user_id": "u", "metrics": {"total_tokens": 7}})),
        dict(TimeGenerated=at(2), Message="audit.business but not JSON"),
        dict(TimeGenerated=at(3), Message="other"),
    ])
    assert [(r.user_id, r.tokens) for r in R.audit_log(traces).collect()] == [(None, None), ("u", "7")]


def test_json_is_parsed_once(spark):
    requests = bronze(spark, "app_requests", [dict(Id="1")])
    spans = S.union_spans(requests, bronze(spark, "app_dependencies", []))
    plan = R.threads_summary(spans.filter(F.col("kind") == "SERVER"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_reports_read_the_span_table(spark):
    requests = bronze(spark, "app_requests", [
        dict(TimeGenerated=at(1), Id="r1", OperationId="o", Name="POST /chat", Properties={"user.id": "u", "thread.id": "t", "tokens.total": "12"}),
    ])
    dependencies = bronze(spark, "app_dependencies", [
        dict(TimeGenerated=at(2), Id="d1", OperationId="o", Name="tool.x", Properties={"tool.input_full": "i", "gen_ai.thread.id": "t"}),
    ])
    spans = S.union_spans(requests, dependencies)
    staged = S.stage_spans(spans)
    for report in (R.users_active, R.threads_summary, R.interactions, R.tool_calls, R.enriched_spans):
        assert sorted(report(staged).collect()) == sorted(report(spans).collect())
        assert "from_json" not in report(staged)._jdf.queryExecution().executedPlan().toString()
