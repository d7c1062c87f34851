"""Declared schemas: three all-string bronze tables and five silver tables."""

from __future__ import annotations

import re

from pyspark.sql import types as T

PARTITION_COLUMN = "date_routine"

# Bronze column names in table order, as the exports name them.
_COMMON_TAIL = """
    Properties Measurements OperationName OperationId {links} ParentId SyntheticSource SessionId
    UserId UserAuthenticatedId UserAccountId AppVersion AppRoleName AppRoleInstance
    ClientType ClientModel ClientOS ClientIP ClientCity ClientStateOrProvince
    ClientCountryOrRegion ClientBrowser ResourceGUID IKey SDKVersion ItemCount
    ReferencedItemId ReferencedType SourceSystem Type _ResourceId
    TimeGeneratedUTCMinus5 date_routine
"""
BRONZE_COLUMNS: dict[str, list[str]] = {
    "app_requests": (
        "TenantId TimeGenerated Id Source Name Url Success ResultCode DurationMs PerformanceBucket "
        + _COMMON_TAIL.format(links="OperationLinks")
    ).split(),
    "app_traces": (
        "TenantId TimeGenerated Message SeverityLevel " + _COMMON_TAIL.format(links="")
    ).split(),
    "app_dependencies": (
        "TenantId TimeGenerated Id Target DependencyType Name Data Success ResultCode DurationMs "
        "PerformanceBucket " + _COMMON_TAIL.format(links="")
    ).split(),
}


def bronze_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in BRONZE_COLUMNS[table]])


def export_columns(table: str) -> list[str]:
    """Columns an export document or CSV carries: all but the derived partition date."""
    return [c for c in BRONZE_COLUMNS[table] if c != PARTITION_COLUMN]


SILVER_SCHEMAS: dict[str, str] = {
    "users": "user_id string, total_interactions bigint, total_tokens bigint",
    "threads": (
        "user_id string, thread_id string, start_time string, end_time string, duration_ms double, "
        "total_input_tokens bigint, total_output_tokens bigint, total_tokens bigint"
    ),
    "runs": (
        "thread_id string, run_id string, agent_id string, model string, start_time string, "
        "end_time string, duration_ms double, status string, input_tokens bigint, "
        "output_tokens bigint, total_tokens bigint, input_message string, output_message string"
    ),
    "run_steps": (
        "run_id string, step_id string, step_type string, start_time string, end_time string, "
        "duration_ms double, status string, input_tokens bigint, output_tokens bigint, "
        "total_tokens bigint"
    ),
    "tools": (
        "step_id string, tool_id string, tool_name string, tool_type string, "
        "tool_description string, start_time string, end_time string, duration_ms double, "
        "input_full string, output_full string, status string"
    ),
}


def silver_columns(table: str) -> list[str]:
    return [part.split()[0] for part in SILVER_SCHEMAS[table].split(",")]


def _column_comment(name: str) -> str:
    """Comment text derived from the column name: ``DurationMs`` -> ``duration ms (raw text)``."""
    words = re.findall(r"[A-Z]+(?=[A-Z][a-z]|$|\d)|[A-Z]?[a-z]+|\d+|[A-Z]+", name)
    return " ".join(w.lower() for w in words) + " (raw text)"


def bronze_ddl(table: str, name: str, fmt: str = "parquet", location: str | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS`` for one bronze table; location and format are the caller's."""
    columns = ",\n  ".join(
        f"`{c}` STRING COMMENT '{_column_comment(c)}'" for c in BRONZE_COLUMNS[table]
    )
    where = f"\nLOCATION '{location}'" if location else ""
    return (
        f"CREATE TABLE IF NOT EXISTS {name} (\n  {columns}\n)\nUSING {fmt}\n"
        f"PARTITIONED BY ({PARTITION_COLUMN})\nCOMMENT 'Raw {table} rows, one string per column'{where}"
    )
