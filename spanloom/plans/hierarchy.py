"""The whole hierarchy in order: as table rows to read, and as one nested JSON document.

A user, thread or run may hold any share of the data, so no node ever gathers its children in
one value. Every node becomes rows of its own with a path that sorts parents before, between
and after their children; a sorted write of the rows is the nested document.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.scalars import JSON_LIMITS, preview
from ..operators.lookup import lookup
from ..operators.ordered import CHUNK, order_chunks, running_last
from ..operators.staging import stage
from ..schemas import SILVER_SCHEMAS, silver_columns
from .silver import Silver, reachable

# Sort key of a row. ``<level>_part``: 0 opens the node, 1 is inside it, 2 closes it.
PATH = [
    "document_part", "user_at", "user_part", "thread_at", "thread_part",
    "run_at", "run_part", "step_at", "step_part", "tool_at",
]
OPEN, INSIDE, CLOSE = 0, 1, 2
LEVELS = ["user", "thread", "run", "step", "tool"]
RUN_PREVIEW, TOOL_PREVIEW = 100, 80


class Levels(NamedTuple):
    user: DataFrame
    thread: DataFrame
    run: DataFrame
    step: DataFrame
    tool: DataFrame


def place_levels(silver: Silver, runs_by_start: bool = False, staged: bool = True) -> Levels:
    """Each level with its path, its parents' ids, and whether it is its parent's first child.

    Paths are written once where the result is sorted, and so read twice; ``staged`` says so.
    """
    keep = stage if staged else lambda df, label: df
    start = [F.col("start_time")] if runs_by_start else []
    users = silver.users.withColumn("user_at", F.struct("user_order", "user_id"))
    threads = silver.threads.withColumn("thread_at", F.struct("thread_order", "thread_id"))
    runs = reachable(silver.runs).withColumn("run_at", F.struct(*start, "run_order", "run_id"))
    steps = reachable(silver.steps)
    tools = reachable(silver.tools).withColumn("tool_at", F.struct("ts", "id", "row_id"))

    def first(children: DataFrame, parent: str, at: str) -> DataFrame:
        return children.groupBy(parent).agg(F.min(at).alias(f"first_{at}"))

    first_user = users.agg(F.min("user_at")).scalar()
    user_path = keep(
        users.join(first(threads, "user_id", "thread_at"), "user_id", "left").select("user_id", "user_at", "first_thread_at"),
        "user-path",
    )
    threads = lookup(threads, user_path, ["user_id"], "inner")
    thread_path = keep(
        threads.join(first(runs, "thread_id", "run_at"), "thread_id", "left").select(
            "user_id", "user_at", "thread_id", "thread_at", "first_run_at"
        ),
        "thread-path",
    )
    runs = lookup(runs, thread_path, ["thread_id"], "inner")
    run_path = keep(
        runs.join(first(steps, "run_id", "step_at"), "run_id", "left")
        .join(first(tools, "run_id", "tool_at"), "run_id", "left")
        .select("user_id", "user_at", "thread_id", "thread_at", "run_id", "run_at", "first_step_at", "first_tool_at"),
        "run-path",
    )
    steps = lookup(steps, run_path.drop("first_tool_at"), ["run_id"], "inner")
    tools = lookup(tools, run_path.drop("first_step_at"), ["run_id"], "inner")

    def is_first(at: str) -> Column:
        return F.col(at) == F.col(f"first_{at}")

    return Levels(
        users.withColumn("is_first", F.col("user_at") == first_user),
        threads.withColumn("is_first", is_first("thread_at")),
        runs.withColumn("is_first", is_first("run_at")),
        steps.withColumn("is_first", is_first("step_at")),
        tools.withColumn("is_first", is_first("tool_at")),
    )


def _parts(level: str, part: int) -> list[Column]:
    """Path columns of an opening or closing row: its parents are entered, itself is ``part``."""
    above = LEVELS[: LEVELS.index(level)]
    columns = [F.lit(INSIDE).alias("document_part")]
    for name in above:
        columns += [F.col(f"{name}_at"), F.lit(INSIDE).alias(f"{name}_part")]
    columns.append(F.col(f"{level}_at"))
    if level != "tool":
        columns.append(F.lit(part).alias(f"{level}_part"))
    return columns


# --- table view -------------------------------------------------------------------------------


def hierarchy_view(silver: Silver) -> DataFrame:
    """One row per node, parents before children, runs by start time, long texts shortened."""
    levels = place_levels(silver, runs_by_start=True)
    ids = {
        "user": ["user_id"],
        "thread": ["user_id", "thread_id"],
        "run": ["user_id", "thread_id", "run_id"],
        "step": ["user_id", "thread_id", "run_id", "step_id"],
        "tool": ["user_id", "thread_id", "run_id", "step_id", "tool_id"],
    }
    shown = {
        "user": ["total_interactions", "total_tokens"],
        "thread": ["duration_ms", "total_tokens"],
        "run": [
            "status", (F.lower("status") == "completed").alias("completed"), "duration_ms",
            "input_tokens", "output_tokens", "total_tokens", "model",
            preview(F.col("input_message"), RUN_PREVIEW).alias("input_preview"),
            preview(F.col("output_message"), RUN_PREVIEW).alias("output_preview"),
        ],
        "step": [F.col("step_type").alias("name"), "duration_ms"],
        "tool": [
            F.col("tool_name").alias("name"), "tool_type", "duration_ms",
            preview(F.col("input_full"), TOOL_PREVIEW).alias("input_preview"),
            preview(F.col("output_full"), TOOL_PREVIEW).alias("output_preview"),
        ],
    }
    view = None
    for level in LEVELS:
        rows = getattr(levels, level).select(F.lit(level).alias("level"), *ids[level], *shown[level], *_parts(level, OPEN))
        view = rows if view is None else view.unionByName(rows, allowMissingColumns=True)
    # A sort reads its input twice, first to find the ranges: joins and previews are not done again for that.
    return stage(view, "view-rows").orderBy(*PATH).drop(*PATH)


# --- JSON document ----------------------------------------------------------------------------


def _fields(level: str) -> list:
    blank = F.lit("")
    zero = F.lit(0)
    texts = lambda *names: F.struct(*[F.col(n) for n in names])
    nothing = F.struct(F.lit(None).cast("string").alias("none"))
    return {
        "user": ["user_id", "total_interactions", "total_tokens", nothing.alias("metadata")],
        "thread": [
            "thread_id", blank.alias("created_at"), "start_time", "end_time", "duration_ms",
            "total_input_tokens", "total_output_tokens", "total_tokens", nothing.alias("metadata"),
        ],
        "run": [
            "run_id", "thread_id", "agent_id", "model", "start_time", "end_time", "duration_ms", "status",
            "input_tokens", "output_tokens", "total_tokens", "input_message", "output_message",
            # a struct of NULLs is written as {}
            F.struct(*[F.col(f"metadata.{c}").alias(c) for c in
                       ("trace_id", "span_id", "user_id", "input_length", "output_length")]).alias("metadata"),
        ],
        "step": [
            "step_id", "step_type", "start_time", blank.alias("end_time"), "duration_ms", "status",
            zero.alias("input_tokens"), zero.alias("output_tokens"), zero.alias("total_tokens"),
            texts("operation_name", "agent_id", "model").alias("metadata"),
        ],
        "tool": [
            "tool_id", "tool_name", "tool_type", "tool_description", "start_time", blank.alias("end_time"),
            "duration_ms", "input_full", "output_full", "status",
            F.struct("call_type", "tool_function", "tool_result").alias("metadata"),
        ],
    }[level]


CHILDREN = {"user": "threads", "thread": "runs", "run": "run_steps", "step": "tools"}
_PARENT = {"user": None, "thread": "user_id", "run": "thread_id", "step": "run_id", "tool": "step_id"}


def json_nodes(silver: Silver, staged: bool = True) -> DataFrame:
    """One row per node: its path and its own fields as a JSON object, children left out."""
    levels = place_levels(silver, staged=staged)
    nodes = None
    for level in LEVELS:
        parent = F.col(_PARENT[level]) if _PARENT[level] else F.lit(None).cast("string")
        rows = getattr(levels, level).select(
            F.lit(level).alias("level"),
            F.col(f"{level}_id").alias("node_id"),
            parent.alias("parent_id"),
            "is_first",
            F.to_json(F.struct(*_fields(level))).alias("node"),
            *_parts(level, OPEN),
        )
        nodes = rows if nodes is None else nodes.unionByName(rows, allowMissingColumns=True)
    return nodes


def json_lines(silver: Silver) -> DataFrame:
    """The document ``{user_id: {..., threads: [{..., runs: [...]}]}}`` as ordered lines of text.

    Each node gives an opening and a closing line in one pass; nothing is joined to close it. The nodes are staged,
    as a sort of the lines reads them twice.
    """
    nodes = stage(json_nodes(silver), "nodes")
    comma = F.when(F.col("is_first"), F.lit("")).otherwise(F.lit(","))
    # a map key is escaped as JSON text is: {"id":""} -> "id":
    key = F.to_json(F.create_map(F.col("node_id"), F.lit("")))
    head = F.when(F.col("level") == "user", F.substring(key, F.lit(2), F.length(key) - 4)).otherwise(F.lit(""))
    children = F.lit("")
    for level, name in CHILDREN.items():
        children = F.when(F.col("level") == level, F.lit(f',"{name}":[')).otherwise(children)
    is_leaf = F.col("level") == "tool"
    opened = F.concat(F.substring(F.col("node"), F.lit(1), F.length("node") - 1), children)
    parts = F.when(is_leaf, F.array(F.lit(OPEN))).otherwise(F.array(F.lit(OPEN), F.lit(CLOSE)))
    rows = nodes.withColumn("_part", F.explode(parts))
    text = F.when(F.col("_part") == CLOSE, F.lit("]}")).otherwise(
        F.concat(comma, head, F.when(is_leaf, F.col("node")).otherwise(opened))
    )
    shifted = {
        f"{level}_part": F.when(F.col("level") == level, F.col("_part")).otherwise(F.col(f"{level}_part"))
        for level in LEVELS[:-1]
    }
    body = rows.withColumn("text", text).withColumns(shifted).select(*PATH, "text")
    spark = body.sparkSession
    frame = spark.range(2).select(
        (F.col("id") * 2).cast("int").alias("document_part"),
        F.when(F.col("id") == 0, F.lit("{")).otherwise(F.lit("}")).alias("text"),
    )
    return body.unionByName(frame, allowMissingColumns=True)


def write_hierarchy_json(silver: Silver, path: str) -> None:
    """Write the document as text files that, joined in name order, are one JSON object."""
    json_lines(silver).orderBy(*PATH).select("text").write.mode("error").text(path)


def read_hierarchy_json(spark: SparkSession, path: str, chunks: int | None = None) -> dict[str, DataFrame]:
    """The five tables out of a document that ``write_hierarchy_json`` has written, by any number of tasks.

    A line opens a node, is a tool, or closes a node. Nodes stand after their parents and before the next
    node of a parent's level, so a node's parent is the last one opened on the level above, which a
    running value over the lines in order gives. Blocks of the files are consecutive ranges of the lines already and
    serve as chunks; ``chunks`` cuts the lines anew into so many.
    """
    part = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long")
    lines = spark.read.text(path).select(
        part.alias("part"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row_id"), "value"
    )
    value, level, tail = F.col("value"), F.lit(None).cast("string"), F.lit(0)
    for name, children in CHILDREN.items():
        end = f',"{children}":['
        level = F.when(value.endswith(end), F.lit(name)).otherwise(level)
        tail = F.when(F.col("level") == name, F.lit(len(end))).otherwise(tail)
    is_tool = (value.startswith('{"') | value.startswith(',{"')) & value.endswith("}")
    leveled = lines.withColumn("level", F.when(is_tool, F.lit("tool")).otherwise(level)).filter(F.col("level").isNotNull())
    head = F.when(F.col("level") == "user", F.instr("value", F.lit(':{"user_id":')) + 1).otherwise(F.instr("value", F.lit("{")))
    node = F.substr("value", head, F.length("value") - head + 1 - tail)
    nodes = leveled.select("part", "start", "row_id", "level", F.when(F.col("level") == "tool", node).otherwise(F.concat(node, F.lit("}"))).alias("node"))
    order = ["part", "start", "row_id"]
    # A struct, as an id may be missing from a node without its node being missing.
    for name in ("user", "run", "step"):
        own = F.when(F.col("level") == name, F.struct(F.get_json_object("node", f"$.{name}_id").alias("id")))
        nodes = nodes.withColumn(f"_{name}", own)
    placed = order_chunks(nodes, [], order, chunks) if chunks else stage(nodes.withColumn(CHUNK, F.struct("part", "start")), "chunks")
    for name in ("user", "run", "step"):
        placed = running_last(placed, [], order, F.col(f"_{name}"), f"in_{name}")
    found = stage(placed.select("level", "node", *[F.col(f"in_{name}.id").alias(f"in_{name}") for name in ("user", "run", "step")]), "document-nodes", ["level"])
    parents = {"threads": ("user_id", "in_user"), "run_steps": ("run_id", "in_run"), "tools": ("step_id", "in_step")}
    tables = {}
    for name, level_name in zip(("users", "threads", "runs", "run_steps", "tools"), LEVELS, strict=True):
        parsed = found.filter(F.col("level") == level_name).select(F.from_json("node", SILVER_SCHEMAS[name], JSON_LIMITS).alias("n"), "in_user", "in_run", "in_step")
        key, parent = parents.get(name, (None, None))
        tables[name] = parsed.select(*[F.col(parent).alias(c) if c == key else F.col(f"n.{c}") for c in silver_columns(name)])
    return tables
