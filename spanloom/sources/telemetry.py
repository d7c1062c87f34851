"""Bronze tables derived from the ``events`` stream table (FIXTURES.md section 5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.ordered import CHUNK, order_chunks, running_last
from ..operators.staging import stage
from ..schemas import bronze_schema


def _text(column: Column) -> Column:
    return column.cast("string")


def _iso(column: Column) -> Column:
    return F.date_format(column.cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def base_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their text time, thread, week and operation."""
    return _with_texts(_weekly(spark.read.parquet(f"{sf_dir}/events.parquet")))


def _weekly(events: DataFrame) -> DataFrame:
    week = F.floor((F.dayofmonth("ts") - 1) / 7).cast("int")
    return events.select("event_id", "ts", "user_id", "event_type", "value", week.alias("week"))


def _with_texts(events: DataFrame) -> DataFrame:
    return events.select(
        "*",
        _iso(F.col("ts")).alias("tg"),
        F.concat(F.lit("th-"), F.col("user_id"), F.lit("-"), F.col("week")).alias("thread_id"),
        F.concat(F.lit("op-"), F.col("user_id"), F.lit("-"), F.dayofmonth("ts")).alias("op_id"),
    )


def _run_name(event_id: Column) -> Column:
    return F.concat(F.lit("run-"), event_id)


def events_with_run(base: DataFrame) -> DataFrame:
    """``base_events`` plus ``cur_run``: the latest purchase of the same user and week.

    Only the stored columns are ordered and staged, and that once for all readers; texts are made from them on reading.
    """
    by, order = ["user_id", "week"], ["ts", "event_id"]
    stored = _weekly(base)
    purchase = F.when(F.col("event_type") == "purchase", F.col("event_id"))
    filled = stage(running_last(order_chunks(stored, by, order), by, order, purchase, "cur_event").drop(CHUNK), "events")
    return _with_texts(filled).withColumn("cur_run", _run_name(F.col("cur_event")))


def conform(df: DataFrame, table: str) -> DataFrame:
    """All declared columns of a bronze table, as strings, in order; absent ones NULL."""
    present = set(df.columns)
    return df.selectExpr(
        *[f"cast({f'`{c}`' if c in present else 'null'} as string) as `{c}`" for c in bronze_schema(table).names]
    )


def _obj(*pairs: tuple[str, Column | str]) -> Column:
    """Flat JSON object of string values: ``{"key":"value",...}``."""
    parts: list[Column] = [F.lit("{")]
    for i, (key, value) in enumerate(pairs):
        lead = "," if i else ""
        parts += [F.lit(f'{lead}"{key}":"'), F.lit(value) if isinstance(value, str) else value, F.lit('"')]
    return F.concat(*parts, F.lit("}"))


def app_requests(base: DataFrame) -> DataFrame:
    """Chat requests (purchases, each its own run) and health checks (signups)."""
    eid, kind = F.col("event_id"), F.col("event_type")
    props = _obj(
        ("user.id", F.col("user_id")),
        ("azure.thread_id", F.col("thread_id")),
        ("azure.run_id", _run_name(eid)),
        ("tokens.total", eid % 500),
        ("message.preview", F.concat(F.lit("m"), eid)),
    )
    is_chat = kind == "purchase"
    rows = base.filter(kind.isin("purchase", "signup")).select(
        F.col("tg").alias("TimeGenerated"),
        F.concat(F.lit("ev-"), eid).alias("Id"),
        F.when(is_chat, F.lit("POST /chat")).otherwise(F.lit("GET /health")).alias("Name"),
        F.col("op_id").alias("OperationId"),
        F.lit("").alias("ParentId"),
        F.lit("true").alias("Success"),
        _text(F.col("value")).alias("DurationMs"),
        F.when(is_chat, props).alias("Properties"),
        F.col("tg").alias("TimeGeneratedUTCMinus5"),
        F.substring("tg", 1, 10).alias("date_routine"),
    )
    return conform(rows, "app_requests")


def app_dependencies(events: DataFrame) -> DataFrame:
    """Agent steps (views), tool calls (clicks) and outgoing calls (every other error)."""
    eid, kind, run = F.col("event_id"), F.col("event_type"), F.col("cur_run")
    every = lambda n: eid % n == 0
    tool_props = F.concat(
        F.lit('{"tool.input_full":"in'), eid, F.lit('","tool.kind":"function"'),
        F.when(every(2), F.lit("")).otherwise(F.concat(F.lit(',"tool.output_full":"out'), eid, F.lit('"'))),
        F.when(every(3), F.concat(F.lit(',"tool.name":"named'), eid % 5, F.lit('"'))).otherwise(F.lit("")),
        F.lit("}"),
    )
    operations = ["start_thread_run", "get_thread_run", "submit_tool_outputs", "create_message", "list_messages"]
    operation = F.coalesce(
        F.try_element_at(F.array(*map(F.lit, operations)), (eid % 6 + 1).cast("int")), F.lit("other")
    )
    usage = F.concat(
        F.lit(',"gen_ai.usage.input_tokens":"'), eid % 90,
        F.lit('","gen_ai.usage.output_tokens":"'), eid % 70,
        F.lit('","gen_ai.usage.total_tokens":"'), eid % 90 + eid % 70, F.lit('"'),
    )
    step_props = F.concat(
        F.lit('{"gen_ai.thread.id":"'), F.col("thread_id"), F.lit('"'),
        F.when(run.isNull(), F.lit("")).otherwise(F.concat(F.lit(',"gen_ai.thread.run.id":"'), run, F.lit('"'))),
        F.lit(',"gen_ai.operation.name":"'), operation,
        F.lit('","gen_ai.agent.id":"agent-'), F.col("user_id") % 5,
        F.lit('","gen_ai.response.model":"m'), eid % 3, F.lit('"'),
        F.when(every(4), usage).otherwise(F.lit("")),
        F.lit("}"),
    )
    name = (
        F.when(kind == "view", F.lit("agent.step"))
        .when(kind == "error", F.lit("POST https://api"))
        .when(every(4), F.lit("search.kb"))
        .otherwise(F.concat(F.lit("tool.t"), eid % 7))
    )
    rows = events.filter(kind.isin("click", "view") | ((kind == "error") & every(2))).select(
        F.col("tg").alias("TimeGenerated"),
        F.concat(F.lit("ev-"), eid).alias("Id"),
        name.alias("Name"),
        F.when(kind == "click", F.lit("InProc")).otherwise(F.lit("HTTP")).alias("DependencyType"),
        F.col("op_id").alias("OperationId"),
        F.concat(F.lit("ev-"), eid - 1).alias("ParentId"),
        F.when(every(10), F.lit("false")).otherwise(F.lit("true")).alias("Success"),
        _text(F.col("value")).alias("DurationMs"),
        F.when(kind == "click", tool_props).when(kind == "view", step_props).alias("Properties"),
        F.col("tg").alias("TimeGeneratedUTCMinus5"),
        F.substring("tg", 1, 10).alias("date_routine"),
    )
    return conform(rows, "app_dependencies")


def app_traces(events: DataFrame) -> DataFrame:
    """User, assistant and tool messages, run completions and business audit lines."""
    eid, kind, run, value = F.col("event_id"), F.col("event_type"), F.col("cur_run"), F.col("value")
    completed = eid % 4 == 1
    audit = F.concat(
        F.lit('{"log_type":"audit.business","thread_id":"'), F.col("thread_id"),
        F.lit('","user_id":"'), F.col("user_id"),
        F.lit('","status":"RunStatus.COMPLETED","conversation":{"input":"ai'), eid,
        F.lit('","output":"ao'), eid,
        F.lit('","input_length":'), eid % 40, F.lit(',"output_length":'), eid % 60,
        F.lit('},"metrics":{"prompt_tokens":'), eid % 80, F.lit(',"completion_tokens":'), eid % 30,
        F.lit(',"total_tokens":'), eid % 80 + eid % 30, F.lit(',"duration_ms":'), _text(value),
        F.lit('},"extra":{"agent_id":"agent-x"'),
        F.when(run.isNull() | (eid % 3 == 0), F.lit("")).otherwise(F.concat(F.lit(',"run_id":"'), run, F.lit('"'))),
        F.lit("}}"),
    )
    message = (
        F.when(kind == "signup", F.lit("gen_ai.user.message"))
        .when(kind == "view", F.lit("gen_ai.assistant.message"))
        .when(kind == "click", F.lit("gen_ai.tool.message"))
        .when(completed, F.lit("run_completed"))
        .otherwise(audit)
    )
    props = (
        F.when(kind == "signup", _obj(
            ("gen_ai.thread.id", F.col("thread_id")),
            ("gen_ai.event.content", F.concat(F.lit('{\\"content\\":\\"hi '), eid, F.lit('\\"}')))))
        .when(kind == "view", _obj(
            ("gen_ai.thread.run.id", run),
            ("gen_ai.event.content",
             F.concat(F.lit('{\\"content\\":{\\"text\\":{\\"value\\":\\"ok '), eid, F.lit('\\"}}}')))))
        .when(kind == "click", _obj(
            ("gen_ai.thread.run.id", run),
            ("gen_ai.event.content",
             F.concat(F.lit('{\\"id\\":\\"c'), eid, F.lit('\\",\\"content\\":\\"tout '), eid, F.lit('\\"}')))))
        .when(completed, _obj(
            ("prompt_tokens", eid % 50),
            ("completion_tokens", eid % 20),
            ("total_tokens", eid % 50 + eid % 20),
            ("duration_ms", _text(value)),
            ("status", "RunStatus.COMPLETED")))
    )
    has_run = run.isNotNull()
    keep = (
        (kind == "signup")
        | ((kind == "view") & (eid % 2 == 1) & has_run)
        | ((kind == "click") & (eid % 2 == 0) & has_run)
        | ((kind == "error") & (eid % 2 == 1))
    )
    rows = events.filter(keep).select(
        F.col("tg").alias("TimeGenerated"),
        message.alias("Message"),
        F.col("op_id").alias("OperationId"),
        props.alias("Properties"),
        F.col("tg").alias("TimeGeneratedUTCMinus5"),
        F.substring("tg", 1, 10).alias("date_routine"),
    )
    return conform(rows, "app_traces")
