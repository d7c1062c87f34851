"""Users, threads and runs from requests and dependencies.

"First" and "last" follow one order key: requests and dependencies by (time, id), request runs
before runs known from dependencies alone. All of them are ``min_by``/``max_by`` aggregates, so
they combine on the map side and never gather a key's rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import (
    explode_if,
    has_null,
    is_success,
    non_empty,
    parse_ts,
    properties_struct,
    safe_double,
    safe_long,
    text_or,
)
from ..operators.lookup import lookup
from ..operators.staging import stage, together

TOKEN_KEYS = {
    "input_tokens": "gen_ai.usage.input_tokens",
    "output_tokens": "gen_ai.usage.output_tokens",
    "total_tokens": "gen_ai.usage.total_tokens",
}
RUN_TEXT_KEYS = {
    "agent_id": "gen_ai.agent.id",
    "model": "gen_ai.response.model",
    "run_status": "gen_ai.thread.run.status",
}


# Property keys of a dependency.
DEPENDENCY_KEYS = [
    *RUN_TEXT_KEYS.values(), *TOKEN_KEYS.values(),
    "gen_ai.thread.run.id", "gen_ai.thread.id", "gen_ai.operation.name",
    "tool.name", "tool.kind", "tool.description", "tool.input_full", "tool.arguments", "tool.output_full",
    "tool.call_type", "tool.function", "tool.result",
]


def first_by(value: Column, order: Column, where: Column) -> Column:
    return F.min_by(value, F.when(where, order))


def last_by(value: Column, order: Column, where: Column) -> Column:
    return F.max_by(value, F.when(where, order))


# --- requests ---------------------------------------------------------------------------------


def chat_requests(requests: DataFrame) -> DataFrame:
    """Chat requests that name a thread."""
    keys = ["user.id", "azure.thread_id", "azure.run_id"]
    bag = explode_if(
        properties_struct(F.col("Properties"), keys),
        lambda found: non_empty(found.getField("azure.thread_id")).isNotNull(),
    )
    return (
        requests.filter(F.col("Name").contains("/chat"))
        .select("TimeGenerated", "Id", "DurationMs", bag.alias("bag"))
        .select(
            parse_ts(F.col("TimeGenerated")).alias("ts"),
            F.col("Id").alias("request_id"),
            F.col("TimeGenerated").alias("start_time"),
            safe_double(F.col("DurationMs")).alias("duration_ms"),
            text_or(F.col("bag").getField("user.id"), "unknown").alias("user_id"),
            F.col("bag").getField("azure.thread_id").alias("thread_id"),
            text_or(F.col("bag").getField("azure.run_id")).alias("run_id"),
        )
    )


def thread_owner(chat: DataFrame) -> DataFrame:
    """The user of the first request of each thread."""
    order = F.struct("ts", "request_id")
    return chat.groupBy("thread_id").agg(
        F.min_by("user_id", order).alias("user_id"), F.min(order).alias("thread_order")
    )


def all_users(chat: DataFrame) -> DataFrame:
    return chat.groupBy("user_id").agg(F.min(F.struct("ts", "request_id")).alias("user_order"))


def run_first(chat: DataFrame) -> DataFrame:
    """Request runs, each with the thread, start and duration of its first request."""
    first = F.min_by(
        F.struct("thread_id", "start_time", "ts", "duration_ms", "request_id"), F.struct("ts", "request_id")
    )
    return (
        chat.filter(F.col("run_id") != "")
        .groupBy("run_id")
        .agg(first.alias("first"))
        .select(
            "run_id",
            "first.thread_id",
            "first.start_time",
            F.col("first.ts").alias("start_ts"),
            "first.duration_ms",
            F.struct(F.lit(0).alias("origin"), F.col("first.ts").alias("ts"), F.col("first.request_id").alias("id")).alias(
                "run_order"
            ),
        )
    )


# --- dependencies -----------------------------------------------------------------------------


def parse_dependencies(dependencies: DataFrame) -> DataFrame:
    """The columns the silver model reads, with ``Properties`` parsed once.

    ``row_id`` tells apart rows that share time and id; it is only stable once staged.
    """
    bag = lambda key: F.col("bag").getField(key)
    name = text_or(F.col("Name"))
    named = bag("tool.name")
    is_tool = (
        name.startswith("tool.")
        | name.startswith("search.")
        | named.isNotNull()
        | has_null(F.col("Properties"), "tool.name")
    )
    tool_name = F.coalesce(
        non_empty(named), F.when(name.startswith("tool."), F.substring(name, 6, 2147483647)), name
    )
    tool = F.struct(
        tool_name.alias("tool_name"),
        text_or(bag("tool.kind"), "function").alias("tool_type"),
        text_or(bag("tool.description")).alias("tool_description"),
        text_or(F.coalesce(non_empty(bag("tool.input_full")), bag("tool.arguments"))).alias("input_full"),
        text_or(bag("tool.output_full")).alias("output_full"),
        F.when(is_success(F.col("Success")), F.lit("completed")).otherwise(F.lit("failed")).alias("status"),
        text_or(bag("tool.call_type")).alias("call_type"),
        text_or(bag("tool.function")).alias("tool_function"),
        text_or(bag("tool.result")).alias("tool_result"),
    )
    texts = {**RUN_TEXT_KEYS, **TOKEN_KEYS}
    return (
        dependencies.select(
            "TimeGenerated", "Id", "Name", "OperationId", "DurationMs", "Success", "Properties",
            properties_struct(F.col("Properties"), DEPENDENCY_KEYS).alias("bag"),
        )
        .select(
            F.monotonically_increasing_id().alias("row_id"),
            parse_ts(F.col("TimeGenerated")).alias("ts"),
            text_or(F.col("Id")).alias("id"),
            text_or(F.col("TimeGenerated")).alias("start_time"),
            non_empty(F.col("OperationId")).alias("operation_id"),
            safe_double(F.col("DurationMs")).alias("duration_ms"),
            non_empty(bag("gen_ai.thread.run.id")).alias("own_run"),
            non_empty(bag("gen_ai.thread.id")).alias("thread_id"),
            text_or(bag("gen_ai.operation.name")).alias("operation_name"),
            *[non_empty(bag(key)).alias(c) for c, key in texts.items()],
            # '' and missing differ for the status of a step
            bag("gen_ai.thread.run.status").alias("raw_status"),
            F.when(is_tool, tool).alias("tool"),
        )
    )


ROW_ORDER = ("ts", "id", "row_id")


def row_order() -> Column:
    return F.struct(*ROW_ORDER)


def operation_runs(deps: DataFrame) -> DataFrame:
    """Operation -> run, the last row that names a run winning."""
    return (
        deps.filter(F.col("own_run").isNotNull() & F.col("operation_id").isNotNull())
        .groupBy("operation_id")
        .agg(F.max_by("own_run", row_order()).alias("operation_run"))
    )


def thread_first_runs(request_runs: DataFrame, deps: DataFrame) -> DataFrame:
    """Thread -> first known run, among request runs and rows that name their run."""
    order = row_order()
    own = (
        deps.filter(F.col("own_run").isNotNull())
        .groupBy(F.col("own_run").alias("run_id"))
        .agg(
            first_by(F.col("thread_id"), order, F.col("thread_id").isNotNull()).alias("thread_id"),
            F.min(order).alias("first"),
        )
        .join(request_runs.select("run_id"), "run_id", "left_anti")
        .filter(F.col("thread_id").isNotNull())
        .select("thread_id", "run_id", _dependency_order(F.col("first")).alias("run_order"))
    )
    known = request_runs.select("thread_id", "run_id", "run_order").unionByName(own)
    return known.groupBy("thread_id").agg(F.min_by("run_id", "run_order").alias("thread_run"))


def _dependency_order(first: Column) -> Column:
    return F.struct(F.lit(1).alias("origin"), first["ts"].alias("ts"), first["id"].alias("id"))


def resolve_dependencies(deps: DataFrame, by_operation: DataFrame, by_thread: DataFrame) -> DataFrame:
    """Give each dependency its run: its own, its operation's, its thread's; drop it otherwise.

    Rows that name their run, as most do, pass without a shuffle; only the others are looked up.
    """
    own = deps.filter(F.col("own_run").isNotNull()).withColumns({"run_id": F.col("own_run"), "via": F.lit("own")})
    others = deps.filter(
        F.col("own_run").isNull() & (F.col("operation_id").isNotNull() | F.col("thread_id").isNotNull())
    )
    found = lookup(lookup(others, by_operation, ["operation_id"]), by_thread, ["thread_id"])
    via = F.when(F.col("operation_run").isNotNull(), F.lit("operation")).otherwise(F.lit("thread"))
    looked_up = found.select(
        *deps.columns, F.coalesce("operation_run", "thread_run").alias("run_id"), via.alias("via")
    ).filter(F.col("run_id").isNotNull())
    return own.unionByName(looked_up)


# --- runs -------------------------------------------------------------------------------------


def _attribute_aggregates() -> list[Column]:
    order = row_order()
    latest = {c: last_by(F.col(c), order, F.col(c).isNotNull()) for c in (*RUN_TEXT_KEYS, *TOKEN_KEYS)}
    return [text_or(latest[c]).alias(c) for c in RUN_TEXT_KEYS] + [
        safe_long(latest[c]).alias(c) for c in TOKEN_KEYS
    ]


def _universe_aggregates() -> list[Column]:
    order = row_order()
    return [
        first_by(F.col("thread_id"), order, F.col("thread_id").isNotNull()).alias("dep_thread"),
        F.min(order).alias("dep_first"),
    ]


def run_attributes(resolved: DataFrame) -> DataFrame:
    """Agent, model, status and each token count of a run: the last non-empty value of each."""
    return resolved.groupBy("run_id").agg(*_attribute_aggregates())


def run_skeleton(request_runs: DataFrame, resolved: DataFrame, threads: DataFrame) -> DataFrame:
    """Every known run with what requests and dependencies say about it.

    ``known_thread`` tells whether the run hangs under a thread that a request has named; only
    such runs reach the outputs.
    """
    from_deps = resolved.groupBy("run_id").agg(*_universe_aggregates(), *_attribute_aggregates())
    zero = F.lit(0).cast("bigint")
    runs = request_runs.join(from_deps, "run_id", "full_outer").select(
        "run_id",
        text_or(F.coalesce("thread_id", "dep_thread")).alias("thread_id"),
        text_or(F.col("start_time")).alias("start_time"),
        "start_ts",
        F.coalesce("duration_ms", F.lit(0.0)).alias("duration_ms"),
        F.coalesce("run_order", _dependency_order(F.col("dep_first"))).alias("run_order"),
        F.col("run_order").isNotNull().alias("from_request"),
        text_or(F.col("agent_id")).alias("agent_id"),
        text_or(F.col("model")).alias("model"),
        text_or(F.col("run_status")).alias("status"),
        *[F.coalesce(c, zero).alias(c) for c in TOKEN_KEYS],
    )
    known = threads.select("thread_id", F.lit(True).alias("known_thread"))
    return lookup(runs, known, ["thread_id"]).withColumn(
        "known_thread", F.coalesce("known_thread", F.lit(False))
    )


class Skeleton(NamedTuple):
    """Staged results of the request and dependency half."""

    chat: DataFrame
    owners: DataFrame
    resolved: DataFrame
    runs: DataFrame


def build_skeleton(requests: DataFrame, dependencies: DataFrame) -> Skeleton:
    """Parse both tables once, resolve dependencies and stage what later steps read again."""
    chat, deps = together(
        lambda: stage(chat_requests(requests), "chat"),
        lambda: stage(parse_dependencies(dependencies), "dependencies"),
    )
    request_runs = run_first(chat)
    resolved = stage(
        resolve_dependencies(deps, operation_runs(deps), thread_first_runs(request_runs, deps)), "resolved"
    )
    owners = thread_owner(chat)
    runs = stage(run_skeleton(request_runs, resolved, owners), "run-skeleton")
    return Skeleton(chat, owners, resolved, runs)
