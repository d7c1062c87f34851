"""What traces say about runs: messages, completions, audit lines, tool outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import (
    STRICT_JSON,
    assistant_text,
    non_empty,
    parse_ts,
    properties_struct,
    safe_double,
    safe_long,
    strip_status,
    text_or,
)
from ..operators.capped import capped_numbers
from ..operators.lookup import lookup
from ..operators.matching import CHUNK_ROWS, NEVER, first_open, greedy_matches
from ..operators.ordered import CHUNK, asof_backward, next_value, order_chunks, row_numbers, running_sum
from ..operators.staging import stage, together
from .runs import first_by, last_by

# Exact messages and the audit marker, in routing order.
USER = "gen_ai.user.message"
ASSISTANT = "gen_ai.assistant.message"
COMPLETED = "run_completed"
AUDIT = "audit.business"
TOOL = "gen_ai.tool.message"

# Property keys of a trace.
TRACE_KEYS = [
    "gen_ai.thread.run.id", "gen_ai.thread.id", "gen_ai.event.content",
    "prompt_tokens", "completion_tokens", "total_tokens", "duration_ms", "status",
]
# The parts of an audit line.
AUDIT_LINE = (
    "log_type string, thread_id string, trace_id string, span_id string, user_id string, status string, "
    "conversation struct<input:string,output:string,input_length:bigint,output_length:bigint>, "
    "metrics map<string,string>, extra struct<run_id:string,agent_id:string>"
)
TRACE_POSITION = ["ts", "tie", "row_id"]
EVENT_FIELDS = ["input_tokens", "output_tokens", "total_tokens", "duration_ms"]


def trace_kind(message: Column) -> Column:
    return (
        F.when(message == USER, "user")
        .when(message == ASSISTANT, "assistant")
        .when(message == COMPLETED, "completed")
        .when(message.contains(AUDIT), "audit")
        .when(message == TOOL, "tool")
        .otherwise("other")
    )


def trace_order() -> Column:
    """Order of traces: time, then a hash of the row, as traces have no id, then the stored row."""
    return F.struct(*TRACE_POSITION)


def route_traces(traces: DataFrame) -> DataFrame:
    """Each trace with its kind and the values that kind carries, parsed once."""
    kind = F.col("kind")
    bag = lambda key: F.col("bag").getField(key)
    is_line = F.col("line.log_type") == AUDIT
    event = bag("gen_ai.event.content")
    plain = F.get_json_object(event, "$.content")
    number = lambda prop, metric, cast: cast(
        F.when(kind == "completed", bag(prop)).when(is_line, F.try_element_at("line.metrics", F.lit(metric)))
    )
    zero = F.lit(0).cast("bigint")
    # A generator of one row: one projection of all columns would be compiled to code too large to run fast.
    step = lambda *columns: F.inline(F.array(F.struct(*columns)))
    return (
        traces.select(
            "TimeGenerated", "OperationId", trace_kind(F.col("Message")).alias("kind"),
            F.xxhash64("Message", "OperationId", "Properties").alias("tie"),
            properties_struct(F.col("Properties"), TRACE_KEYS).alias("bag"),
            F.when(
                F.col("Message").contains(AUDIT) & F.col("Message").startswith("{"),
                F.from_json("Message", AUDIT_LINE, STRICT_JSON),
            ).alias("line"),
        )
        .filter(kind != "other")
        .select("*", step(
            F.when(kind == "assistant", assistant_text(event))
            .when(kind.isin("user", "tool"), text_or(plain))
            .alias("text"),
            F.when(kind == "tool", text_or(F.get_json_object(event, "$.id"))).alias("message_id"),
        ))
        .select("*", step(
            number("prompt_tokens", "prompt_tokens", safe_long).alias("input_tokens"),
            number("completion_tokens", "completion_tokens", safe_long).alias("output_tokens"),
            number("total_tokens", "total_tokens", safe_long).alias("total_tokens"),
            number("duration_ms", "duration_ms", safe_double).alias("duration_ms"),
        ))
        .select(
            kind,
            F.monotonically_increasing_id().alias("row_id"),
            parse_ts(F.col("TimeGenerated")).alias("ts"),
            "tie",
            text_or(F.col("TimeGenerated")).alias("time_text"),
            non_empty(bag("gen_ai.thread.run.id")).alias("run_id"),
            non_empty(bag("gen_ai.thread.id")).alias("thread_id"),
            "text", "message_id", *EVENT_FIELDS,
            strip_status(F.when(kind == "completed", bag("status")).otherwise(F.col("line.status"))).alias("status"),
            F.when(kind == "completed", F.lit(True))
            .otherwise(F.coalesce(F.size("line.metrics") > 0, F.lit(False)))
            .alias("has_metrics"),
            F.coalesce(is_line, F.lit(False)).alias("valid_audit"),
            non_empty(F.col("line.extra.run_id")).alias("audit_run"),
            non_empty(F.col("line.thread_id")).alias("audit_thread"),
            non_empty(F.col("line.extra.agent_id")).alias("agent_id"),
            text_or(F.col("line.conversation.input")).alias("input"),
            text_or(F.col("line.conversation.output")).alias("output"),
            F.when(
                is_line,
                F.struct(
                    text_or(F.col("line.trace_id")).alias("trace_id"),
                    text_or(F.col("line.span_id")).alias("span_id"),
                    text_or(F.col("line.user_id")).alias("user_id"),
                    F.coalesce("line.conversation.input_length", zero).alias("input_length"),
                    F.coalesce("line.conversation.output_length", zero).alias("output_length"),
                ),
            ).alias("audit"),
        )
    )


def stage_traces(traces: DataFrame) -> DataFrame:
    """Routed traces on shared storage, one folder per kind, so a reader scans only its kind."""
    return stage(route_traces(traces), "traces", partition_by=["kind"])


def of_kind(routed: DataFrame, kind: str) -> DataFrame:
    return routed.filter(F.col("kind") == kind)


# --- messages ---------------------------------------------------------------------------------


def started_runs(runs: DataFrame) -> DataFrame:
    """Runs that can be found by time, with the columns as-of joins need."""
    return runs.filter(F.col("start_ts").isNotNull()).select(
        "thread_id", "run_id", F.col("start_ts").alias("ts"), "run_order", "total_tokens"
    )


def user_message_runs(routed: DataFrame, runs: DataFrame, chunks: int | None = None) -> DataFrame:
    """User messages with the latest run of their thread that started no later, if any."""
    messages = of_kind(routed, "user").filter(F.col("thread_id").isNotNull()).select("thread_id", *TRACE_POSITION, "text")
    targets = started_runs(runs).select("thread_id", "ts", "run_id", "run_order")
    found = asof_backward(messages, targets, ["thread_id"], "ts", ["tie", "row_id"], ["run_order", "run_id"], "run", chunks)
    return found.select("thread_id", *TRACE_POSITION, "text", F.col("run.run_id").alias("run_id"))


def assistant_messages(routed: DataFrame, runs: DataFrame) -> DataFrame:
    """Assistant messages of known runs."""
    messages = of_kind(routed, "assistant").filter(F.col("run_id").isNotNull()).select("run_id", *TRACE_POSITION, "text")
    return lookup(messages, runs.select("run_id"), ["run_id"], "inner")


def first_texts(messages: DataFrame, out: str) -> DataFrame:
    """First non-empty text per run."""
    text = F.col("text")
    return messages.groupBy("run_id").agg(text_or(first_by(text, trace_order(), text != "")).alias(out))


# --- events that settle a run -----------------------------------------------------------------


def completion_runs(
    routed: DataFrame, runs: DataFrame, owners: DataFrame, audits: DataFrame, chunks: int | None = None, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """``run_completed`` events with the run that each settles; events without one are left out.

    A completion names no run. Threads are asked in the order in which requests first named them, and the
    first whose current run, the latest started by then, has no tokens yet gives that run. A completion
    with tokens uses the run up; so does an audit line with tokens, from its place in the order of
    traces on. Completions without a readable time have no run.
    """
    spent = (
        audits.filter(F.col("has_metrics") & (F.col("total_tokens") != 0))
        .groupBy(F.col("run_id").alias("spent_run")).agg(F.min(trace_order()).alias("at"))
        .select("spent_run", "at.*", F.lit(1).alias("side"))
    )
    starts = started_runs(runs.filter("known_thread")).withColumn("side", F.lit(0))
    events = of_kind(routed, "completed").filter(F.col("ts").isNotNull()).select(
        *TRACE_POSITION, "time_text", *EVENT_FIELDS, "status", F.lit(1).alias("side")
    )
    both = (
        starts.withColumnRenamed("total_tokens", "known_tokens")
        .unionByName(events.withColumn("is_event", F.lit(True)), allowMissingColumns=True)
        .unionByName(spent, allowMissingColumns=True)
    )
    order = ["ts", "side", "run_order", "run_id", "tie", "row_id"]
    by_thread = ["thread_order", "thread_id"]
    line, ranked = together(
        lambda: stage(row_numbers(order_chunks(both, [], order, chunks), [], order, "number").withColumn("seq", F.col("number") - 1).drop(CHUNK), "run-line"),
        lambda: row_numbers(order_chunks(owners.select("thread_id", "thread_order"), [], by_thread, chunks), [], by_thread, "rank"),
    )
    own = line.filter("side = 0").select("thread_id", "run_id", "seq", "known_tokens")
    followed = next_value(order_chunks(own, ["thread_id"], ["seq"], chunks), ["thread_id"], ["seq"], F.col("seq"), "next_seq")
    spent_at = line.filter(F.col("spent_run").isNotNull()).select(F.col("spent_run").alias("run_id"), F.col("seq").alias("spent_seq"))
    placed = lookup(lookup(followed.filter("known_tokens = 0"), spent_at, ["run_id"]), ranked.select("thread_id", "rank"), ["thread_id"])
    end = F.least(F.coalesce("next_seq", F.lit(NEVER)), F.coalesce("spent_seq", F.lit(NEVER)))
    windows = stage(
        placed.select(F.col("run_id").alias("id"), "rank", F.col("seq").alias("start"), end.alias("end")).filter("end > start"), "run-windows"
    )
    events = line.filter("is_event")
    taken = stage(greedy_matches(windows, events.filter("total_tokens <> 0").select("seq"), chunk_rows), "settled-runs")
    left = windows.join(taken.withColumnRenamed("seq", "taken"), "id", "left").withColumn("end", F.least("end", "taken"))
    seen = first_open(left.drop("taken"), events.filter("total_tokens = 0").select("seq"), chunk_rows)
    found = taken.select("seq", F.col("id").alias("own_run")).unionByName(seen.select("seq", F.col("id").alias("own_run")))
    return events.join(found, "seq").select(
        F.col("own_run").alias("run_id"), *TRACE_POSITION, "time_text", *EVENT_FIELDS, "status"
    )


def audit_runs(routed: DataFrame, runs: DataFrame) -> DataFrame:
    """Valid audit lines with their run: the one they name, else the first of their thread."""
    lines = routed.filter((F.col("kind") == "audit") & F.col("valid_audit")).select(
        "audit_run", "audit_thread", *TRACE_POSITION, "time_text", *EVENT_FIELDS, "status", "has_metrics",
        "agent_id", "input", "output", "audit",
    )
    named = runs.select(F.col("run_id").alias("audit_run"), F.lit(True).alias("run_known"))
    first = (
        runs.filter(F.col("thread_id") != "")
        .groupBy(F.col("thread_id").alias("audit_thread"))
        .agg(F.min_by("run_id", "run_order").alias("thread_run"))
    )
    found = lookup(lookup(lines, named, ["audit_run"]), first, ["audit_thread"])
    run = F.when(F.col("run_known"), F.col("audit_run")).otherwise(F.col("thread_run"))
    return found.withColumn("run_id", run).filter(F.col("run_id").isNotNull()).drop(
        "audit_run", "audit_thread", "run_known", "thread_run"
    )


def all_events(completions: DataFrame, audits: DataFrame) -> DataFrame:
    """Completions and audit lines, with their runs, in one table."""
    return completions.withColumns({"is_completion": F.lit(True), "has_metrics": F.lit(True)}).unionByName(
        audits.withColumn("is_completion", F.lit(False)), allowMissingColumns=True
    )


def finish_runs(runs: DataFrame, events: DataFrame, inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Runs with tokens, times, status and texts settled by traces.

    ``events``, and the input and output messages, are one union reduced by one aggregate per run.
    """
    order = trace_order()
    facts = (
        events.select("*", F.col("input").alias("in_text"), F.col("output").alias("out_text"), F.lit(True).alias("is_event"))
        .unionByName(inputs.select("run_id", *TRACE_POSITION, F.col("text").alias("in_text")), allowMissingColumns=True)
        .unionByName(outputs.select("run_id", *TRACE_POSITION, F.col("text").alias("out_text")), allowMissingColumns=True)
    )
    usage = F.struct(*EVENT_FIELDS)
    is_event, has_metrics = F.col("is_event"), F.col("is_event") & F.col("has_metrics")
    settled = facts.groupBy("run_id").agg(
        F.coalesce(
            first_by(usage, order, has_metrics & (F.col("total_tokens") != 0)), last_by(usage, order, has_metrics)
        ).alias("usage"),
        last_by(F.struct("status", F.col("time_text").alias("end_time")), order, is_event).alias("last"),
        last_by(F.col("agent_id"), order, F.col("agent_id").isNotNull()).alias("last_agent"),
        last_by(F.col("audit"), order, F.col("audit").isNotNull()).alias("metadata"),
        text_or(first_by(F.col("in_text"), order, F.col("in_text") != "")).alias("input_message"),
        text_or(first_by(F.col("out_text"), order, F.col("out_text") != "")).alias("output_message"),
    )
    own = F.col("total_tokens") != 0
    pick = lambda c: F.when(own | F.col("usage").isNull(), F.col(c)).otherwise(F.col(f"usage.{c}")).alias(c)
    return runs.join(settled, "run_id", "left").select(
        "thread_id", "run_id",
        F.coalesce("last_agent", "agent_id").alias("agent_id"),
        "model", "start_time", "start_ts",
        text_or(F.col("last.end_time")).alias("end_time"),
        pick("duration_ms"),
        F.coalesce("last.status", "status").alias("status"),
        *[pick(c) for c in ("input_tokens", "output_tokens", "total_tokens")],
        text_or(F.col("input_message")).alias("input_message"),
        text_or(F.col("output_message")).alias("output_message"),
        "metadata", "run_order", "known_thread",
    )


# --- tool outputs -----------------------------------------------------------------------------


def tool_message_fills(routed: DataFrame, tools: DataFrame, chunks: int | None = None) -> DataFrame:
    """Tool (``row_id``) -> output text from messages.

    A non-empty message goes through the tools of its run in order and stops at the first that has
    its id or has no output; it fills that tool if it has none and is dropped otherwise.
    """
    messages = (
        of_kind(routed, "tool")
        .filter(F.col("run_id").isNotNull() & non_empty(F.col("text")).isNotNull())
        .select("run_id", *TRACE_POSITION, "message_id", "text")
    )
    by = ["run_id"]
    tool_order, message_order = ["ts", "id", "row_id"], TRACE_POSITION
    own = tools.select("run_id", "ts", "id", "row_id", "tool_id", (F.col("output_full") == "").cast("long").alias("empty"))
    placed, ordered = together(
        lambda: order_chunks(own, by, tool_order, chunks), lambda: order_chunks(messages, by, message_order, chunks)
    )
    numbered = stage(running_sum(placed, by, tool_order, F.col("empty"), "before"), "tool-places")
    # Tools without output up to the first tool of the id: once that many are filled, the message meets its tool first.
    limits = numbered.groupBy("run_id", F.col("tool_id").alias("message_id")).agg(
        F.min_by(F.col("before") + F.col("empty"), F.struct(*tool_order)).alias("limit")
    )
    limited = stage(lookup(ordered, limits, ["run_id", "message_id"]), "limited-messages")
    filling = capped_numbers(limited, "run_id", message_order, "limit", "nth")
    return numbered.filter("empty = 1").select("run_id", (F.col("before") + 1).alias("nth"), "row_id").join(
        filling.select("run_id", "nth", F.col("text").alias("fill")), ["run_id", "nth"]
    )


def fill_tools(tools: DataFrame, fills: DataFrame) -> DataFrame:
    filled = tools.join(fills.select("row_id", "fill"), "row_id", "left")
    return filled.withColumn("output_full", F.coalesce("fill", "output_full")).drop("fill")
