"""Spans: requests and dependencies in one table, with their attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import attr, explode_if, parse_ts, properties_map
from ..operators.lookup import lookup
from ..operators.staging import stage

# Property keys behind each span attribute, in order of preference.
SPAN_ATTRIBUTES: dict[str, list[str]] = {
    "user_id": ["user.id"],
    "thread_id": ["gen_ai.thread.id", "thread.id", "azure.thread_id"],
    "run_id": ["gen_ai.thread.run.id", "run.id", "azure.run_id"],
    "tool_name": ["tool.name"],
    "tool_input": ["tool.input_full"],
    "tool_output": ["tool.output_full"],
    "tokens_total": ["gen_ai.usage.total_tokens", "tokens.total"],
    "message_preview": ["message.preview", "agent.response.preview"],
}


def _spans(rows: DataFrame, kind) -> DataFrame:
    return rows.select(
        parse_ts(F.col("TimeGenerated")).alias("timestamp"),
        F.col("OperationId").alias("trace_id"),
        F.col("Id").alias("span_id"),
        F.col("ParentId").alias("parent_span_id"),
        F.col("Name").alias("name"),
        kind.alias("kind"),
        F.col("DurationMs").try_cast("double").alias("duration_ms"),
        F.col("Success").alias("success"),
        F.col("Properties"),
    )


def request_spans(requests: DataFrame) -> DataFrame:
    return _spans(requests, F.lit("SERVER"))


def dependency_spans(dependencies: DataFrame) -> DataFrame:
    return _spans(dependencies, F.col("DependencyType"))


def union_spans(requests: DataFrame, dependencies: DataFrame) -> DataFrame:
    return request_spans(requests).unionByName(dependency_spans(dependencies))


def with_attributes(spans: DataFrame, only: list[str] | None = None, required: str | None = None) -> DataFrame:
    """Add the attribute columns (all, or ``only`` some), reading ``Properties`` in one parse.

    With ``required``, spans without that attribute are left out, still in the same parse. Of a
    staged span table the columns are read as they are, and nothing is parsed.
    """
    wanted = {name: keys for name, keys in SPAN_ATTRIBUTES.items() if only is None or name in only}

    if set(wanted) <= set(spans.columns):
        return spans.filter(F.col(required).isNotNull()) if required else spans

    def value(bag: Column, name: str) -> Column:
        return F.coalesce(*[attr(bag, k) for k in wanted[name]])

    bag = properties_map(F.col("Properties"))
    if required:
        bag = explode_if(bag, lambda found: value(found, required).isNotNull())
    columns = []
    for name in wanted:
        text = value(F.col("_props"), name)
        columns.append((text.try_cast("int") if name == "tokens_total" else text).alias(name))
    return spans.select(*spans.columns, bag.alias("_props")).select(*spans.columns, *columns)


def build_spans(requests: DataFrame, dependencies: DataFrame) -> DataFrame:
    return with_attributes(union_spans(requests, dependencies))


def stage_spans(spans: DataFrame) -> DataFrame:
    """The span table: spans with all attributes, parsed and written once for every later report."""
    return stage(with_attributes(spans), "spans")


def fill_over_trace(spans: DataFrame, columns: tuple[str, ...] = ("user_id", "thread_id")) -> DataFrame:
    """Spread each column's first non-null value by time over its whole trace, as ``<col>_filled``.

    The value does not depend on the row, so it is one aggregate per trace, combined on the map
    side, and a lookup. No task ever holds a whole trace. Spans without a trace id form one
    group, like any other trace.
    """
    position = F.struct("timestamp", "span_id")
    # only spans with a value take part; a trace without any gets NULL from the lookup
    values = explode_if(
        F.struct(*columns), lambda found: F.coalesce(*[found.getField(c) for c in columns]).isNotNull()
    )
    firsts = (
        spans.select("trace_id", "timestamp", "span_id", values.alias("_values"))
        .select("trace_id", "timestamp", "span_id", "_values.*")
        .groupBy("trace_id")
        .agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), position)).alias(f"{c}_filled") for c in columns])
    )
    return lookup(spans, firsts, ["trace_id"], null_safe=True)
