"""The conversation model on hand-written rows, and its invariants on generated ones."""

from __future__ import annotations

import json
import random
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from spanloom import catalog
from spanloom.catalog import Workspace
from spanloom.plans import hierarchy as H, messages as M
from spanloom.plans.runs import build_skeleton
from spanloom.plans.silver import build_silver
from spanloom.schemas import SILVER_SCHEMAS
from spanloom.sources import telemetry as T

from .test_spans import bronze


@pytest.fixture(scope="module", autouse=True)
def quick_small_plans(spark):
    """Many plans over a few rows: compile nothing. The oracle tests run the compiled plans."""
    quick = {"spark.sql.shuffle.partitions": "2", "spark.sql.codegen.wholeStage": "false",
             "spark.sql.codegen.factoryMode": "NO_CODEGEN"}
    before = {k: spark.conf.get(k) for k in quick}
    for k, v in quick.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def at(minute: int) -> str:
    return f"2024-01-01T00:{minute:02d}:00Z"


def request(i, minute, user=None, thread=None, run=None, **more):
    props = {"user.id": user, "azure.thread_id": thread, "azure.run_id": run}
    return dict(Id=i, TimeGenerated=at(minute), Name="POST /chat", DurationMs="5",
                Properties={k: v for k, v in props.items() if v is not None}) | more


def dependency(i, minute, run=None, thread=None, op=None, name="step", operation=None, props=None, **more):
    bag = {"gen_ai.thread.run.id": run, "gen_ai.thread.id": thread, "gen_ai.operation.name": operation}
    bag = {k: v for k, v in bag.items() if v is not None} | (props or {})
    return dict(Id=i, TimeGenerated=at(minute), Name=name, OperationId=op, DurationMs="2", Success="true",
                Properties=bag) | more


def trace(minute, message, props=None):
    return dict(TimeGenerated=at(minute), Message=message, Properties=props or {})


def user_message(minute, thread, text):
    return trace(minute, "gen_ai.user.message",
                 {"gen_ai.thread.id": thread, "gen_ai.event.content": json.dumps({"content": text})})


def assistant_message(minute, run, content):
    return trace(minute, "gen_ai.assistant.message",
                 {"gen_ai.thread.run.id": run, "gen_ai.event.content": json.dumps({"content": content})})


def tool_message(minute, run, text, i="call"):
    return trace(minute, "gen_ai.tool.message",
                 {"gen_ai.thread.run.id": run, "gen_ai.event.content": json.dumps({"content": text, "id": i})})


def completed(minute, total, duration="9"):
    return trace(minute, "run_completed", {
        "prompt_tokens": str(total), "completion_tokens": "0", "total_tokens": str(total), "duration_ms": duration,
        "status": "RunStatus.COMPLETED"})


def audit(minute, run=None, thread=None, total=None, text="", agent=None, **more):
    line = {"log_type": "audit.business", "thread_id": thread, "status": "RunStatus.FAILED", "user_id": "au",
            "conversation": {"input": text, "output": text}, "extra": {"run_id": run, "agent_id": agent}}
    if total is not None:
        line["metrics"] = {"total_tokens": total, "duration_ms": 77}
    return trace(minute, json.dumps(line | more))


def silver(spark, requests=(), dependencies=(), traces=()):
    return build_silver(
        bronze(spark, "app_requests", list(requests)),
        bronze(spark, "app_dependencies", list(dependencies)),
        bronze(spark, "app_traces", list(traces)),
    )


def rows(df, key, *columns):
    return {r[key]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()}


def test_no_rows_gives_five_empty_tables(spark):
    for name, df in silver(spark).tables().items():
        declared = spark.createDataFrame([], SILVER_SCHEMAS[name])
        assert df.dtypes == declared.dtypes and df.count() == 0


def test_users_threads_and_runs_from_requests(spark):
    tables = silver(spark, [
        request("1", 1, "u1", "t1", "r1"),
        request("2", 2, "u2", "t1", "r1", DurationMs="99"),  # the thread and the run belong to the first
        request("3", 3, None, "t2", "r2", Name="GET /chat/x", DurationMs=None),
        request("4", 4, "", "t3"),
        request("5", 5, "u9", None, "r9"),
        request("6", 6, "u9", "t9", "r8", Name="GET /health"),
        request("7", 7, "u1", "t1", "r7"),
    ]).tables()
    assert rows(tables["users"], "user_id", "total_interactions") == {"u1": 2, "u2": 0, "unknown": 1, "": 0}
    assert rows(tables["threads"], "thread_id", "user_id", "duration_ms") == {
        "t1": ("u1", 360000.0), "t2": ("unknown", 0.0), "t3": ("", 0.0)}
    assert rows(tables["runs"], "run_id", "thread_id", "duration_ms") == {
        "r1": ("t1", 5.0), "r2": ("t2", 0.0), "r7": ("t1", 5.0)}
    assert rows(tables["threads"], "thread_id", "start_time")["t1"] == "2024-01-01T00:01:00+00:00"
    assert rows(tables["threads"], "thread_id", "start_time")["t3"] == ""


def test_dependencies_find_their_run(spark):
    tool = dict(name="tool.x", op="o1")
    model = silver(spark, [request("1", 1, "u", "t1", "r1"), request("2", 2, "u", "t2", "r2")], [
        dependency("own", 3, run="r1", **tool),
        dependency("own2", 4, run="r2", op="o1"),  # the last row of an operation that names a run wins
        dependency("by-op", 1, **tool),
        dependency("by-thread", 5, thread="t1", name="tool.x"),
        dependency("none", 5, thread="t8", name="tool.x"),
        dependency("new", 6, run="r3", name="tool.x"),
        dependency("new-thread", 7, run="r3", thread="t1"),  # gives r3 its thread
        dependency("lost", 8, run="r4", thread="t9", name="tool.x"),  # no request knows t9
    ])
    assert rows(model.tools, "tool_id", "run_id") == {
        "own": "r1", "by-op": "r2", "by-thread": "r1", "new": "r3", "lost": "r4"}
    tables = model.tables()
    assert rows(tables["runs"], "run_id", "thread_id", "start_time") == {
        "r1": ("t1", at(1)), "r2": ("t2", at(2)), "r3": ("t1", "")}
    assert "lost" not in rows(tables["tools"], "tool_id", "step_id")


def test_last_non_empty_attribute_wins(spark):
    tables = silver(spark, [request("1", 1, "u", "t", "r")], [
        dependency("1", 2, run="r", props={"gen_ai.agent.id": "a1", "gen_ai.usage.total_tokens": "7", "gen_ai.usage.input_tokens": "3.9"}),
        dependency("2", 3, run="r", props={"gen_ai.agent.id": "", "gen_ai.usage.total_tokens": "0", "gen_ai.thread.run.status": "s"}),
    ]).tables()
    assert rows(tables["runs"], "run_id", "agent_id", "status", "input_tokens", "total_tokens") == {"r": ("a1", "s", 3, 0)}


def test_tools_and_steps(spark):
    tables = silver(spark, [request("1", 1, "u", "t", "r1"), request("2", 1, "u", "t", "r2")], [
        dependency("a", 2, run="r1", name="tool.x", props={"tool.input_full": "", "tool.arguments": "args", "tool.kind": ""}),
        dependency("b", 3, run="r1", name="search.y", Success="False"),
        dependency("c", 4, run="r1", name="plain", props={"tool.name": "named", "tool.input_full": "in"}),
        dependency("d", 5, run="r1", name="plain", props={"tool.name": None}),
        dependency("s0", 2, run="r1", operation="create_message"),
        dependency("s1", 3, run="r1", operation="submit_tool_outputs"),
        dependency("s2", 4, run="r1", operation="submit_tool_outputs", props={"gen_ai.thread.run.status": ""}),
        dependency("s3", 5, run="r1", operation="other"),
        dependency("e", 6, run="r2", name="tool.z"),
    ]).tables()
    assert rows(tables["tools"], "tool_id", "step_id", "tool_name", "tool_type", "input_full", "status") == {
        "a": ("s1", "x", "", "args", "completed"),
        "b": ("s1", "search.y", "function", "", "failed"),
        "c": ("s1", "named", "function", "in", "completed"),
        "d": ("s1", "plain", "function", "", "completed"),
        "e": ("step_tools_r2", "z", "function", "", "completed"),
    }
    assert rows(tables["run_steps"], "step_id", "step_type", "duration_ms", "status", "start_time") == {
        "s0": ("message_creation", 2.0, "completed", at(2)),
        "s1": ("tool_calls", 8.0, "completed", at(3)),
        "s2": ("tool_calls", 2.0, "", at(4)),
        "step_tools_r2": ("tool_calls", 2.0, "completed", at(6)),
    }


def test_messages_find_their_run_by_time(spark):
    tables = silver(spark, [
        request("1", 10, "u", "t", "r1"), request("2", 20, "u", "t", "r2"), request("3", 20, "u", "t", "r3"),
        request("4", 5, "u", "other", "r4"),
    ], traces=[
        user_message(9, "t", "before any run"),
        user_message(10, "t", "same instant"),
        user_message(15, "t", "later"),
        user_message(25, "t", "after two of one time: the last"),
        user_message(6, "other", ""),
        user_message(7, "other", "first with text"),
        assistant_message(11, "r1", ""),
        assistant_message(12, "r1", {"text": {"value": "value"}}),
        assistant_message(13, "r1", "late"),
        assistant_message(13, "nobody", "lost"),
    ]).tables()
    assert rows(tables["runs"], "run_id", "input_message", "output_message") == {
        "r1": ("same instant", "value"), "r2": ("", ""), "r3": ("after two of one time: the last", ""),
        "r4": ("first with text", ""),
    }


def test_completions(spark):
    runs = [request("1", 10, "u", "t1", "r1"), request("2", 20, "u", "t2", "r2"), request("3", 30, "u", "t1", "r3")]
    tokens = {"gen_ai.usage.total_tokens": "4"}

    def settle(*traces, deps=()):
        tables = silver(spark, runs, deps, traces).tables()
        return rows(tables["runs"], "run_id", "total_tokens", "duration_ms", "end_time")

    # the thread that was named first is asked first; a run with tokens is passed over
    assert settle(completed(25, 3))["r1"] == (3, 9.0, at(25))
    assert settle(completed(25, 3), deps=[dependency("d", 1, run="r1", props=tokens)]) == {
        "r1": (4, 5.0, ""), "r2": (3, 9.0, at(25)), "r3": (0, 5.0, "")}
    # each with tokens uses a run up, and the next goes to the next thread
    both = settle(completed(25, 3), completed(26, 4, "8"), completed(27, 5))
    assert both["r1"] == (3, 9.0, at(25)) and both["r2"] == (4, 8.0, at(26)) and both["r3"] == (0, 5.0, "")
    # one without tokens does not use it up
    assert settle(completed(21, 0), completed(22, 5, "1"))["r1"] == (5, 1.0, at(22))
    # only the current run of a thread is asked
    late = settle(completed(35, 3))
    assert late["r3"] == (3, 9.0, at(35)) and late["r1"] == (0, 5.0, "")
    # an audit with tokens settles the run before the completion arrives
    spent = settle(audit(21, run="r1", total=8), completed(22, 5))
    assert spent["r1"] == (8, 77.0, at(21)) and spent["r2"] == (5, 9.0, at(22))
    # before any run
    assert settle(completed(5, 3)) == settle()


def replay_completions(threads, traces):
    """The rule event by event: ``threads`` lists (thread, [(start, run)]) in order of first mention."""
    tokens, settled = {r: 0 for _, own in threads for _, r in own}, {}
    for minute, run, total in traces:
        if run is None:
            for _, own in threads:
                started = [r for start, r in sorted(own) if start <= minute]
                if started and not tokens[started[-1]]:
                    tokens[started[-1]], settled[started[-1]] = total, at(minute)
                    break
        else:
            settled[run] = at(minute)
            if total is not None and not tokens[run]:
                tokens[run] = total
    return {r: (tokens[r], settled.get(r, "")) for r in tokens}


@pytest.mark.parametrize("seed", range(4))
def test_completions_over_overlapping_threads(spark, seed):
    """Completions with and without tokens and audit lines, in chunks of a few positions, against a replay."""
    rng = random.Random(seed)
    requests, threads = [], {}
    for minute in sorted(rng.sample(range(50), 22)):
        thread, run = f"t{rng.randrange(6)}", f"r{minute}"
        threads.setdefault(thread, []).append((minute, run))
        requests.append(request(str(minute), minute, "u", thread, run))
    known = [r for own in threads.values() for _, r in own]
    events = [
        (minute, None, rng.choice([0, 3, 4])) if rng.random() < 0.8 else (minute, rng.choice(known), rng.choice([None, 0, 9]))
        for minute in sorted(rng.sample(range(60), 30))
    ]
    lines = [completed(m, total) if run is None else audit(m, run=run, total=total) for m, run, total in events]
    skeleton = build_skeleton(bronze(spark, "app_requests", requests), bronze(spark, "app_dependencies", []))
    routed = M.stage_traces(bronze(spark, "app_traces", lines))
    audits = M.audit_runs(routed, skeleton.runs)
    rows_of = lambda **sizes: M.finish_runs(
        skeleton.runs, M.all_events(M.completion_runs(routed, skeleton.runs, skeleton.owners, audits, **sizes), audits),
        M.user_message_runs(routed, skeleton.runs), M.assistant_messages(routed, skeleton.runs),
    )
    wanted = replay_completions(list(threads.items()), events)
    assert rows(rows_of(chunks=3, chunk_rows=10), "run_id", "total_tokens", "end_time") == wanted


def test_audit_lines(spark):
    model = silver(spark, [request("1", 10, "u", "t1", "r1"), request("2", 20, "u", "t1", "r2")], [
        dependency("d", 1, run="r1", props={"gen_ai.agent.id": "old"}),
    ], [
        audit(11, run="r2", text="named", total=3, agent="new"),
        audit(12, run="unknown", thread="t1", text="by thread"),
        audit(13, run="r2", text="second", agent=""),
        trace(14, '{"log_type":"other","x":"audit.business"}'),
        trace(15, "audit.business, not JSON"),
        trace(16, '{"log_type":"audit.business",'),
        audit(17, thread="t1", extra=None, metrics=None),
    ])
    runs = rows(model.tables()["runs"], "run_id", "input_message", "status", "agent_id", "total_tokens", "end_time")
    assert runs == {
        "r1": ("by thread", "FAILED", "old", 0, at(17)),
        "r2": ("named", "FAILED", "new", 3, at(13)),
    }
    assert model.runs.filter("run_id = 'r2'").select("metadata.user_id").first()[0] == "au"


def test_tool_messages_fill_empty_outputs_in_order(spark):
    tables = silver(spark, [request("1", 1, "u", "t", "r")], [
        dependency("a", 2, run="r", name="tool.a"),
        dependency("b", 3, run="r", name="tool.b", props={"tool.output_full": "own"}),
        dependency("c", 4, run="r", name="tool.c"),
    ], [
        tool_message(5, "r", ""),
        tool_message(6, "r", "one: the empty tool comes first", "b"),
        tool_message(7, "r", "dropped: its tool has an output by now", "a"),
        tool_message(7, "r", "dropped: its tool comes first", "b"),
        tool_message(8, "r", "two"),
        tool_message(9, "r", "no tool left"),
        tool_message(9, "nobody", "lost"),
    ]).tables()
    assert rows(tables["tools"], "tool_id", "output_full") == {"a": "one: the empty tool comes first", "b": "own", "c": "two"}


@pytest.fixture(scope="module")
def generated(spark):
    return Workspace(spark, "/root/testdata/sf0.001")


def test_levels_agree(generated):
    tables = generated.tables
    total = lambda t, c: tables[t].agg(F.sum(c)).first()[0]
    assert total("threads", "total_tokens") == total("runs", "total_tokens") == total("users", "total_tokens") > 0
    assert total("users", "total_interactions") == tables["runs"].count()
    assert tables["tools"].join(tables["run_steps"], "step_id", "left_anti").count() == 0
    assert tables["run_steps"].join(tables["runs"], "run_id", "left_anti").count() == 0


def test_row_order_does_not_matter(generated):
    mixed = build_silver(*[generated.bronze[t].orderBy(F.rand(5)) for t in ("app_requests", "app_dependencies", "app_traces")])
    for name, df in mixed.tables().items():
        # sums of doubles depend on the order of addition in their last digits
        round_off = lambda d: [F.round(c, 6).alias(c) if kind == "double" else c for c, kind in d.dtypes]
        found, want = (d.select(*round_off(d)).collect() for d in (df, generated.tables[name]))
        assert sorted(map(tuple, found)) == sorted(map(tuple, want)), name


def test_json_document(generated, tmp_path):
    path = tmp_path / "json"
    H.write_hierarchy_json(generated.silver, str(path))
    text = "\n".join(p.read_text(encoding="utf-8") for p in sorted(Path(path).glob("part-*")))
    users = json.loads(text)
    threads = [(u, t) for u in users.values() for t in u["threads"]]
    runs = [(t, r) for _, t in threads for r in t["runs"]]
    steps = [(r, s) for _, r in runs for s in r["run_steps"]]
    tools = [(s, x) for _, s in steps for x in s["tools"]]
    flat = {
        "users": [(k, u["user_id"], u["total_interactions"], u["total_tokens"]) for k, u in users.items()],
        "threads": [(u["user_id"], t["thread_id"], t["duration_ms"], t["total_tokens"]) for u, t in threads],
        "runs": [(t["thread_id"], r["run_id"], r["total_tokens"], r["output_message"]) for t, r in runs],
        "run_steps": [(r["run_id"], s["step_id"], s["duration_ms"], s["status"]) for r, s in steps],
        "tools": [(s["step_id"], x["tool_id"], x["output_full"], x["tool_name"]) for s, x in tools],
    }
    columns = {
        "users": ["user_id", "user_id", "total_interactions", "total_tokens"],
        "threads": ["user_id", "thread_id", "duration_ms", "total_tokens"],
        "runs": ["thread_id", "run_id", "total_tokens", "output_message"],
        "run_steps": ["run_id", "step_id", "duration_ms", "status"],
        "tools": ["step_id", "tool_id", "output_full", "tool_name"],
    }
    for name, found in flat.items():
        want = [tuple(r[c] for c in columns[name]) for r in generated.tables[name].collect()]
        assert sorted(found) == sorted(want), name
    assert set(runs[0][1]["metadata"]) <= {"trace_id", "span_id", "user_id", "input_length", "output_length"}


def test_document_is_read_back(spark, generated, tmp_path):
    path = str(tmp_path / "json")
    H.write_hierarchy_json(generated.silver, path)
    back = H.read_hierarchy_json(spark, path, chunks=5)
    for name, df in generated.tables.items():
        assert back[name].dtypes == df.dtypes, name
        assert sorted(map(str, back[name].collect())) == sorted(map(str, df.collect())), name


def test_document_of_odd_ids_and_texts_is_read_back(spark, tmp_path):
    odd = 'x":{"user_id":"y\\'
    model = silver(spark, [request("1", 1, odd, "t{", 'r"threads":['), request("2", 2, "u", "t2", "r2")], [
        dependency("a", 2, run="r2", name='tool.x"tools":['), dependency("b", 3, run='r"threads":[', name="tool.y", props={"tool.output_full": "]}\n{"}),
    ])
    H.write_hierarchy_json(model, str(tmp_path / "j"))
    back = H.read_hierarchy_json(spark, str(tmp_path / "j"))
    for name, df in model.tables().items():
        assert sorted(map(str, back[name].collect())) == sorted(map(str, df.collect())), name
    H.write_hierarchy_json(silver(spark), str(tmp_path / "empty"))
    assert all(df.count() == 0 for df in H.read_hierarchy_json(spark, str(tmp_path / "empty")).values())


def test_json_of_odd_ids(spark, tmp_path):
    odd = 'q"uo\\te'
    H.write_hierarchy_json(silver(spark, [request("1", 1, odd, "t", "r"), request("2", 2, "u", "t2")]), str(tmp_path / "j"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "j").glob("part-*")))
    assert set(json.loads(text)) == {odd, "u"}
    H.write_hierarchy_json(silver(spark), str(tmp_path / "empty"))
    assert json.loads("".join(p.read_text() for p in sorted((tmp_path / "empty").glob("part-*")))) == {}


def test_view_lists_parents_first(generated):
    seen = set()
    for r in H.hierarchy_view(generated.silver).collect():
        chain = [r.user_id, r.thread_id, r.run_id, r.step_id, r.tool_id]
        path = tuple(c for c in chain if c is not None)
        assert len(path) == 1 or path[:-1] in seen
        seen.add(path)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sorts_read_staged_rows(generated):
    """A sort reads its input twice, so no join may stand below it."""
    for df in (H.hierarchy_view(generated.silver), H.json_lines(generated.silver).orderBy(*H.PATH)):
        assert "rangepartitioning" in plan_of(df) and "Join" not in plan_of(df)


def test_blocks_of_the_document_serve_as_chunks(spark, generated, tmp_path, monkeypatch):
    H.json_lines(generated.silver).repartitionByRange(7, *H.PATH).sortWithinPartitions(*H.PATH).select("text").write.text(str(tmp_path / "j"))
    monkeypatch.delattr(H, "order_chunks")  # the lines stand in order already and are not sorted again
    back = H.read_hierarchy_json(spark, str(tmp_path / "j"))
    for name, df in generated.tables.items():
        assert sorted(map(str, back[name].collect())) == sorted(map(str, df.collect())), name


def test_events_are_ordered_once_for_all_readers(spark):
    rows = [(1, "2024-01-01 10:00:00", 5, "view", 1.0), (2, "2024-01-01 11:00:00", 5, "purchase", 2.0),
            (3, "2024-01-02 10:00:00", 5, "click", 3.0), (4, "2024-01-09 10:00:00", 5, "view", 4.0), (5, None, 6, "click", 5.0)]
    base = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double")
    events = T.events_with_run(base.withColumn("ts", F.col("ts").cast("timestamp_ntz")))
    assert {r.event_id: (r.cur_run, r.thread_id, r.op_id) for r in events.collect()} == {
        1: (None, "th-5-0", "op-5-1"), 2: ("run-2", "th-5-0", "op-5-1"), 3: ("run-2", "th-5-0", "op-5-2"), 4: (None, "th-5-1", "op-5-9"),
        5: (None, None, None),
    }
    for df in (T.app_dependencies(events), T.app_traces(events)):
        assert "Window" not in plan_of(df) and "Sort" not in plan_of(df)


def test_hierarchy_json_parses_each_node_once(spark, monkeypatch):
    rows = [
        ("user", None, '{"user_id":"u1","total_interactions":2,"total_tokens":7,"metadata":{}}'),
        ("thread", "u1", '{"thread_id":"t1","created_at":"","duration_ms":0.00001234567,"total_tokens":7,"metadata":{}}'),
        ("run", "t1", '{"run_id":"r1","thread_id":"t1","duration_ms":"NaN","total_tokens":9223372036854775807,"metadata":{"user_id":"u\\"é"}}'),
        ("step", "r1", '{"step_id":"s1","duration_ms":1.23456E7,"total_tokens":0,"metadata":{"operation_name":"","agent_id":"a"}}'),
        ("tool", "s1", '{"tool_id":"","duration_ms":5,"output_full":"a\\nb😀","metadata":{"call_type":""}}'),
        ("tool", "s1", '{"tool_name":"without an id"}'),
    ]
    nodes = spark.createDataFrame(rows, "level string, parent_id string, node string").repartition(1)
    monkeypatch.setattr(catalog.H, "json_nodes", lambda silver, staged: nodes)
    found = catalog.QUERIES["hierarchy_json"](SimpleNamespace(silver=None))
    value = lambda name: F.get_json_object("node", f"$.{name}")
    plain = nodes.select(
        "level", "parent_id", F.coalesce(*[value(f"{level}_id") for level in ("tool", "step", "run", "thread", "user")]).alias("node_id"),
        value("total_tokens").cast("bigint").alias("total_tokens"), F.round(value("duration_ms").cast("double"), 4).alias("duration_ms"),
        value("metadata.user_id").alias("meta_user"), value("metadata.operation_name").alias("meta_operation"),
        F.length(value("output_full")).alias("output_length"),
    )
    assert found.schema.simpleString() == plain.schema.simpleString()
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and "get_json_object" not in plan
