"""Tools and run steps of each run."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import text_or
from ..operators.lookup import lookup
from .runs import row_order

# Operations that count as steps of a run.
STEP_OPERATIONS = [
    "start_thread_run",
    "get_thread_run",
    "submit_tool_outputs",
    "create_message",
    "list_messages",
]
TOOL_STEP = "tool_calls"


def extract_tools(resolved: DataFrame) -> DataFrame:
    """Dependencies that are tool executions."""
    return resolved.filter(F.col("tool").isNotNull()).select(
        "run_id", "row_id", "ts", "id", F.col("id").alias("tool_id"), "start_time", "duration_ms", "tool.*"
    )


def extract_steps(resolved: DataFrame) -> DataFrame:
    """Dependencies that are steps of the agent."""
    step_type = F.when(F.col("operation_name") == "submit_tool_outputs", F.lit(TOOL_STEP)).otherwise(
        F.lit("message_creation")
    )
    return resolved.filter(F.col("operation_name").isin(STEP_OPERATIONS)).select(
        "run_id", "row_id", "ts", "id",
        F.col("id").alias("step_id"),
        step_type.alias("step_type"),
        "start_time", "duration_ms",
        text_or(F.col("raw_status"), "completed").alias("status"),
        "operation_name",
        text_or(F.col("agent_id")).alias("agent_id"),
        text_or(F.col("model")).alias("model"),
    )


class Attached(NamedTuple):
    steps: DataFrame
    tools: DataFrame


def step_position(row_id: Column, ts: Column, id: Column) -> Column:
    """Place of a step in its run; a made-up step has no row and comes first."""
    rank = F.when(row_id.isNull(), 0).otherwise(1)
    return F.struct(rank.alias("rank"), ts.alias("ts"), id.alias("id"), row_id.alias("row_id"))


def attach_tools(steps: DataFrame, tools: DataFrame) -> Attached:
    """Hang all tools of a run under its first tool step, or under a step made for them.

    The tool step takes the summed duration of its tools. Made-up steps come first in the run.
    """
    order = row_order()
    per_run = tools.groupBy("run_id").agg(
        F.sum("duration_ms").alias("tools_ms"), F.min_by("start_time", order).alias("tools_start")
    )
    first_step = (
        steps.filter(F.col("step_type") == TOOL_STEP)
        .groupBy("run_id")
        .agg(F.min_by(F.struct("row_id", "step_id", "ts", "id"), order).alias("host"))
    )
    hosts = per_run.join(first_step, "run_id", "left").select(
        "run_id", "tools_ms", "tools_start",
        F.col("host.row_id").alias("host_row"),
        step_position(F.col("host.row_id"), F.col("host.ts"), F.col("host.id")).alias("step_at"),
        F.coalesce("host.step_id", F.concat(F.lit("step_tools_"), F.col("run_id"))).alias("host_step"),
    )
    hosted = hosts.filter(F.col("host_row").isNotNull()).select(F.col("host_row").alias("row_id"), "tools_ms")
    kept = steps.join(hosted, "row_id", "left").select(
        "run_id", "row_id", "ts", "id", "step_id", "step_type", "start_time",
        F.coalesce("tools_ms", "duration_ms").alias("duration_ms"),
        "status", "operation_name", "agent_id", "model",
    )
    made = hosts.filter(F.col("host_row").isNull()).select(
        "run_id",
        F.lit(None).cast("bigint").alias("row_id"),
        F.lit(None).cast("timestamp").alias("ts"),
        F.lit(None).cast("string").alias("id"),
        F.col("host_step").alias("step_id"),
        F.lit(TOOL_STEP).alias("step_type"),
        text_or(F.col("tools_start")).alias("start_time"),
        F.col("tools_ms").alias("duration_ms"),
        F.lit("completed").alias("status"),
    )
    all_steps = kept.unionByName(made, allowMissingColumns=True).withColumn(
        "step_at", step_position(F.col("row_id"), F.col("ts"), F.col("id"))
    )
    placed = lookup(tools, hosts.select("run_id", F.col("host_step").alias("step_id"), "step_at"), ["run_id"])
    return Attached(all_steps, placed)
