"""The conversation model: users, threads, runs, run steps and tools."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from ..functions.scalars import iso_utc, millis_between, text_or
from ..operators.lookup import lookup
from ..operators.staging import stage, together
from ..schemas import silver_columns
from . import messages as M
from .runs import Skeleton, all_users, build_skeleton
from .tools import attach_tools, extract_steps, extract_tools

TOTALS = {
    "total_input_tokens": "input_tokens",
    "total_output_tokens": "output_tokens",
    "total_tokens": "total_tokens",
}


def build_runs(skeleton: Skeleton, routed: DataFrame) -> DataFrame:
    """Final runs, those without a known thread included."""
    runs = skeleton.runs

    def settled() -> DataFrame:
        audits = stage(M.audit_runs(routed, runs), "audits")
        return M.all_events(M.completion_runs(routed, runs, skeleton.owners, audits), audits)

    asked, events = together(lambda: M.user_message_runs(routed, runs), settled)
    inputs = asked.filter(F.col("run_id").isNotNull())
    return M.finish_runs(runs, events, inputs, M.assistant_messages(routed, runs))


def reachable(runs: DataFrame) -> DataFrame:
    return runs.filter("known_thread")


def thread_rollup(runs: DataFrame, owners: DataFrame) -> DataFrame:
    """Tokens, span of time and number of runs per thread; threads without runs count zero."""
    per_thread = (
        reachable(runs)
        .groupBy("thread_id")
        .agg(
            *[F.sum(source).alias(total) for total, source in TOTALS.items()],
            F.min("start_ts").alias("first_ts"),
            F.max("start_ts").alias("last_ts"),
            F.count(F.lit(1)).alias("run_count"),
        )
    )
    zero = F.lit(0).cast("bigint")
    return owners.join(per_thread, "thread_id", "left").select(
        "user_id", "thread_id", "thread_order",
        text_or(iso_utc(F.col("first_ts"))).alias("start_time"),
        text_or(iso_utc(F.col("last_ts"))).alias("end_time"),
        F.coalesce(millis_between(F.col("first_ts"), F.col("last_ts")), F.lit(0.0)).alias("duration_ms"),
        *[F.coalesce(total, zero).alias(total) for total in TOTALS],
        F.coalesce("run_count", zero).alias("run_count"),
    )


def user_rollup(threads: DataFrame, users: DataFrame) -> DataFrame:
    """Interactions and tokens per user; a user who owns no thread counts zero."""
    per_user = threads.groupBy("user_id").agg(
        F.sum("run_count").alias("total_interactions"), F.sum("total_tokens").alias("total_tokens")
    )
    zero = F.lit(0).cast("bigint")
    return users.join(per_user, "user_id", "left").select(
        "user_id", "user_order",
        F.coalesce("total_interactions", zero).alias("total_interactions"),
        F.coalesce("total_tokens", zero).alias("total_tokens"),
    )


class Silver(NamedTuple):
    """The five levels with their order and parent columns; ``tables`` gives the plain outputs.

    ``runs``, ``steps`` and ``tools`` are staged, and still hold what hangs under no known thread.
    """

    users: DataFrame
    threads: DataFrame
    runs: DataFrame
    steps: DataFrame
    tools: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        """Users, threads, runs, run_steps and tools in their declared schemas, even when empty."""
        zero = F.lit(0).cast("bigint")
        nothing = F.lit("").alias("end_time")
        steps = reachable(self.steps).select(
            "*", nothing, *[zero.alias(c) for c in ("input_tokens", "output_tokens", "total_tokens")]
        )
        frames = {
            "users": self.users,
            "threads": self.threads,
            "runs": reachable(self.runs),
            "run_steps": steps,
            "tools": reachable(self.tools).select("*", nothing),
        }
        return {name: df.select(*silver_columns(name)) for name, df in frames.items()}


def build_silver(requests: DataFrame, dependencies: DataFrame, traces: DataFrame) -> Silver:
    """Whole model. Raw tables are parsed once; what several levels read again is staged."""
    skeleton, routed = together(
        lambda: build_skeleton(requests, dependencies), lambda: M.stage_traces(traces)
    )
    found = extract_tools(skeleton.resolved)
    hosted = attach_tools(extract_steps(skeleton.resolved), found)
    known = skeleton.runs.select("run_id", "known_thread")

    def filled_tools() -> DataFrame:
        fills = M.tool_message_fills(routed, found)
        return stage(M.fill_tools(lookup(hosted.tools, known, ["run_id"]), fills), "tools")

    runs, steps, tools = together(
        lambda: stage(build_runs(skeleton, routed), "runs"),
        lambda: stage(lookup(hosted.steps, known, ["run_id"]), "run-steps"),
        filled_tools,
    )
    # Every later view reads the rollups, so they are written once too.
    threads = stage(thread_rollup(runs, skeleton.owners), "threads")
    users = stage(user_rollup(threads, all_users(skeleton.chat)), "users")
    return Silver(users, threads, runs, steps, tools)

