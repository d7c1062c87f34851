"""Reports over spans and traces. Each narrows to the rows and attributes it needs first."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.scalars import JSON_LIMITS
from .spans import fill_over_trace, with_attributes

CHAT = "POST /chat"


def latest_first(rows: DataFrame) -> DataFrame:
    """Rows by time, newest first. The row number of the scan ends the key, so that the sort can
    cut apart any number of rows of one instant, copies too."""
    return (
        rows.withColumn("_row", F.monotonically_increasing_id()).orderBy(F.desc("timestamp"), "_row").drop("_row")
    )


def users_active(spans: DataFrame) -> DataFrame:
    """Chat requests per user; requests without a user are one group."""
    chats = with_attributes(spans.filter(F.col("name") == CHAT), ["user_id"])
    return chats.groupBy("user_id").agg(F.count(F.lit(1)).alias("total_requests"))


def threads_summary(spans: DataFrame) -> DataFrame:
    """Interactions, tokens and last activity per conversation, latest first."""
    rows = with_attributes(spans, ["thread_id", "tokens_total"], required="thread_id")
    return (
        rows.groupBy("thread_id")
        .agg(
            F.count(F.when(F.col("name") == CHAT, 1)).alias("interacciones"),
            F.sum("tokens_total").alias("tokens_consumidos"),
            F.max("timestamp").alias("ultimo_mensaje"),
        )
        .orderBy(F.desc("ultimo_mensaje"), "thread_id")
    )


def interactions(spans: DataFrame) -> DataFrame:
    chats = with_attributes(
        spans.filter(F.col("name") == CHAT), ["user_id", "thread_id", "message_preview", "tokens_total"]
    )
    return latest_first(
        chats.select("timestamp", "user_id", "thread_id", "duration_ms", "message_preview", "tokens_total")
    )


def tool_calls(spans: DataFrame) -> DataFrame:
    tools = with_attributes(spans.filter(F.col("name").startswith("tool.")), ["tool_input", "tool_output"])
    return latest_first(
        tools.select("timestamp", "trace_id", "name", "duration_ms", "tool_input", "tool_output", "success")
    )


def audit_log(traces: DataFrame) -> DataFrame:
    """Business audit lines; time and tokens stay text, as they are in the log."""
    line = F.from_json(
        "Message",
        "user_id string, conversation struct<input:string,output:string>, metrics struct<total_tokens:string>",
        JSON_LIMITS,
    )
    lines = (
        traces.filter(F.col("Message").contains("audit.business"))
        .select("TimeGenerated", "OperationId", line.alias("line"))
        .select(
            F.col("TimeGenerated").alias("timestamp"),
            F.col("OperationId").alias("trace_id"),
            F.col("line.user_id").alias("user_id"),
            F.col("line.conversation.input").alias("input_completo"),
            F.col("line.conversation.output").alias("output_completo"),
            F.col("line.metrics.total_tokens").alias("tokens"),
        )
    )
    return latest_first(lines)


def enriched_spans(spans: DataFrame) -> DataFrame:
    """Every span with the user and thread of its trace."""
    return fill_over_trace(with_attributes(spans, ["user_id", "thread_id", "tool_name"])).select(
        "timestamp", "name", "kind", "user_id_filled", "thread_id_filled", "tool_name"
    )
