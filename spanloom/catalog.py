"""Named queries over a folder of the driver's tables; each derives its telemetry from ``events``."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from .functions import scalars as C
from .operators.staging import stage, stage_path
from .plans import analysis as A, daily as D, hierarchy as H, messages as M, reports as R, runs as U, silver as V, spans as S, store as K, tools as X
from .schemas import PARTITION_COLUMN
from .sinks.bronze import overwrite_bronze, retained
from .sinks.versions import VersionedTable
from .sources import telemetry as T
from .sources.export import read_export, with_partition_date
from .sources.tables import CSV_OPTIONS, profile, read_csv
from .streaming.exports import load_new_exports

Query = Callable[["Workspace"], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


class Workspace:
    """Telemetry of one folder; each part is planned when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def stage_bronze(self) -> None:
        """Write the derived bronze tables once, as a loader would, and read them from there on."""
        for name, df in self.bronze.items():
            setattr(self, name.removeprefix("app_"), stage(df, name, [PARTITION_COLUMN]))
        del self.bronze

    @cached_property
    def base(self) -> DataFrame:
        return T.base_events(self.spark, self.sf_dir)

    @cached_property
    def events(self) -> DataFrame:
        return T.events_with_run(self.base)

    @cached_property
    def requests(self) -> DataFrame:
        return T.app_requests(self.base)

    @cached_property
    def dependencies(self) -> DataFrame:
        return T.app_dependencies(self.events)

    @cached_property
    def traces(self) -> DataFrame:
        return T.app_traces(self.events)

    @cached_property
    def bronze(self) -> dict[str, DataFrame]:
        return {"app_requests": self.requests, "app_dependencies": self.dependencies, "app_traces": self.traces}

    @cached_property
    def spans(self) -> DataFrame:
        return S.union_spans(self.requests, self.dependencies)

    @cached_property
    def span_table(self) -> DataFrame:
        return S.stage_spans(self.spans)

    @property
    def report_spans(self) -> DataFrame:
        """The staged span table once there is one."""
        return self.__dict__.get("span_table", self.spans)

    @cached_property
    def skeleton(self) -> U.Skeleton:
        return U.build_skeleton(self.requests, self.dependencies)

    @cached_property
    def routed(self) -> DataFrame:
        return M.stage_traces(self.traces)

    @cached_property
    def audits(self) -> DataFrame:
        return stage(M.audit_runs(self.routed, self.skeleton.runs), "audits")

    @cached_property
    def silver(self) -> V.Silver:
        return V.build_silver(self.requests, self.dependencies, self.traces)

    @cached_property
    def tables(self) -> dict[str, DataFrame]:
        return self.silver.tables()


def micros(column: str, out: str | None = None):
    return F.unix_micros(F.col(column)).alias(out or column)


def rounded(column: str):
    return F.round(column, 4).alias(column)


# --- bronze -----------------------------------------------------------------------------------

_REQUEST_COLUMNS = ["TimeGenerated", "Id", "Name", "OperationId", "DurationMs", "Success", "Properties", "date_routine"]


_EXPORT_TEXT = ["TimeGenerated", "Id", "Name", "OperationId", "Properties", "TimeGeneratedUTCMinus5"]
_EXPORT_RAW = ["DurationMs", "Success"]  # written as a JSON number and a JSON boolean
_DOCUMENT_EVENTS = 1 << 16  # events per document, so that documents stay small and grow in number


def _write_exports(requests: DataFrame, path: str) -> None:
    """Export documents, one file each. The empty row that ends ``rows`` is a reject by its width."""
    header = ",".join(f'{{"name":"{c}"}}' for c in _EXPORT_TEXT + _EXPORT_RAW)
    texts = F.to_json(F.array(*_EXPORT_TEXT))
    row = F.concat(F.rtrim(texts, F.lit("]")), F.lit(","), F.concat_ws(",", *_EXPORT_RAW), F.lit("],"))
    number = F.substring("Id", 4, 20).cast("bigint")
    rows = requests.withColumn("document", F.floor(number / _DOCUMENT_EVENTS)).select(
        "document", F.lit(1).alias("part"), row.alias("value")
    )
    ends = F.array(
        F.struct(F.lit(0).alias("part"), F.lit('{"tables":[{"columns":[' + header + '],"rows":[').alias("value")),
        F.struct(F.lit(2).alias("part"), F.lit("[]]}]}").alias("value")),
    )
    frame = rows.groupBy("document").agg(F.count("part")).select("document", F.inline(ends))
    (
        rows.unionByName(frame)
        .repartition("document")
        .sortWithinPartitions("document", "part")
        .select("document", "value")
        .write.partitionBy("document")
        .text(path)
    )


@query
def export_unpack(w: Workspace) -> DataFrame:
    """Write requests as export documents and read them back."""
    path = stage_path(w.spark, "export")
    _write_exports(w.requests, path)
    return read_export(w.spark, path, "app_requests", short_rows="drop").select(_REQUEST_COLUMNS)


@query
def csv_roundtrip(w: Workspace) -> DataFrame:
    """Write traces as CSV (JSON with quotes inside cells) and read them back."""
    path = stage_path(w.spark, "csv")
    w.traces.write.options(header="true", quote=CSV_OPTIONS["quote"], escape=CSV_OPTIONS["escape"]).csv(path)
    return read_csv(w.spark, path, "app_traces").select("TimeGenerated", "Message", "OperationId", "Properties", "date_routine")


@query
def bronze_overwrite(w: Workspace) -> DataFrame:
    """Overwrite a partitioned table twice; the second write replaces the first."""
    path = stage_path(w.spark, "bronze")
    overwrite_bronze(w.requests, path=path)
    overwrite_bronze(w.requests, path=path)
    return w.spark.read.schema(w.requests.schema).parquet(path).select(_REQUEST_COLUMNS)


@query
def export_ranges(w: Workspace) -> DataFrame:
    """The same documents, each cut into its rows by byte ranges."""
    path = stage_path(w.spark, "export")
    _write_exports(w.requests, path)
    return read_export(w.spark, path, "app_requests", short_rows="drop", large=0).select(_REQUEST_COLUMNS)


@query
def csv_ranges(w: Workspace) -> DataFrame:
    """The same CSV files, cut into records by byte ranges."""
    path = stage_path(w.spark, "csv")
    w.traces.write.options(header="true", quote=CSV_OPTIONS["quote"], escape=CSV_OPTIONS["escape"]).csv(path)
    rows = read_csv(w.spark, path, "app_traces", large=0)
    return rows.select("TimeGenerated", "Message", "OperationId", "Properties", "date_routine")


@query
def bronze_versions(w: Workspace) -> DataFrame:
    """Requests written as one version of a table and purged in the next."""
    table = VersionedTable(w.spark, stage_path(w.spark, "versions"), "app_requests")
    table.overwrite(w.requests)
    table.purge("2024-01-10T12:00:00Z")
    return table.read().select(_REQUEST_COLUMNS)


@query
def bronze_date(w: Workspace) -> DataFrame:
    return with_partition_date(w.requests).select("Id", "date_routine")


@query
def scan_all(w: Workspace) -> DataFrame:
    return w.dependencies.select(
        "TimeGenerated", "Id", "Name", "DependencyType", "OperationId", "ParentId", "Success", "DurationMs",
        "Properties", "date_routine",
    )


@query
def table_profile(w: Workspace) -> DataFrame:
    return profile(w.bronze)


@query
def retention_keep(w: Workspace) -> DataFrame:
    return retained(w.requests, "2024-01-10T00:00:00Z").select("Id", "TimeGenerated")


# --- spans and reports ------------------------------------------------------------------------


@query
def span_union(w: Workspace) -> DataFrame:
    return w.spans.withColumn("timestamp", micros("timestamp"))


@query
def span_table(w: Workspace) -> DataFrame:
    """The staged span table with its attributes."""
    return w.span_table.drop("Properties").withColumn("timestamp", micros("timestamp"))


@query
def span_attrs(w: Workspace) -> DataFrame:
    return S.with_attributes(w.spans).select("span_id", *S.SPAN_ATTRIBUTES)


@query
def span_fill(w: Workspace) -> DataFrame:
    return R.enriched_spans(w.report_spans).withColumn("timestamp", micros("timestamp"))


@query
def users_active(w: Workspace) -> DataFrame:
    return R.users_active(w.report_spans)


@query
def threads_summary(w: Workspace) -> DataFrame:
    return R.threads_summary(w.report_spans).withColumn("ultimo_mensaje", micros("ultimo_mensaje"))


@query
def interactions(w: Workspace) -> DataFrame:
    return R.interactions(w.report_spans).withColumn("timestamp", micros("timestamp"))


@query
def tool_calls(w: Workspace) -> DataFrame:
    return R.tool_calls(w.report_spans).withColumn("timestamp", micros("timestamp"))


@query
def audit_log(w: Workspace) -> DataFrame:
    return R.audit_log(w.traces)


def _buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@query
def span_store_fill(w: Workspace) -> DataFrame:
    """The trace fill out of a store bucketed by trace."""
    path = stage_path(w.spark, "span_store")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    K.save_span_store(w.spans, table, _buckets(w.spark), path)
    return K.stored_fill(w.spark, table).select(
        micros("timestamp"), "name", "kind", "user_id_filled", "thread_id_filled", "tool_name"
    )


@query
def run_store_attrs(w: Workspace) -> DataFrame:
    """Run attributes out of a store of dependencies bucketed by run."""
    path = stage_path(w.spark, "run_store")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    K.save_run_store(w.skeleton.resolved, table, _buckets(w.spark), path)
    return K.stored_run_attributes(w.spark, table)


def _daily(w: Workspace, name: str) -> DataFrame:
    """A report merged from the states of two loads: the days to the 15th, and those after it."""
    root = stage_path(w.spark, "daily")
    bronze = {source: f"{root}/bronze/{source}" for source in D.SOURCES}
    states = D.DailyStates(w.spark, f"{root}/states")
    for first in (True, False):
        for source, path in bronze.items():
            early = F.col(PARTITION_COLUMN) <= "2024-01-15"
            rows = w.bronze[source].filter(early if first else ~early)
            rows.write.mode("append").partitionBy(PARTITION_COLUMN).parquet(path)
        states.add(bronze)
    return states.report(name)


@query
def daily_users_active(w: Workspace) -> DataFrame:
    return _daily(w, "users_active")


@query
def daily_threads_summary(w: Workspace) -> DataFrame:
    return _daily(w, "threads_summary").withColumn("ultimo_mensaje", micros("ultimo_mensaje"))


@query
def daily_run_first(w: Workspace) -> DataFrame:
    return _daily(w, "run_first")


@query
def daily_op_run_map(w: Workspace) -> DataFrame:
    return _daily(w, "op_run_map")


@query
def export_stream(w: Workspace) -> DataFrame:
    """The export documents loaded by the stream, in two calls."""
    path = stage_path(w.spark, "stream")
    for half in (0, 1):
        _write_exports(w.requests.filter(F.substring("Id", 4, 20).cast("bigint") % 2 == half), f"{path}/in/{half}")
        load_new_exports(w.spark, f"{path}/in/*/*", f"{path}/out", f"{path}/checkpoint", "app_requests", short_rows="drop")
    return w.spark.read.schema(w.requests.schema).parquet(f"{path}/out").select(_REQUEST_COLUMNS)


# --- scalars ----------------------------------------------------------------------------------


def _odd_texts(w: Workspace) -> DataFrame:
    """Number and time texts of every event, good and bad, by turns."""
    eid, value = F.col("event_id"), F.col("value").cast("string")
    odd = {1: "", 2: None, 3: "abc", 4: "NaN", 5: "Infinity", 6: "1e3"}
    number = F.when(eid % 8 == 0, value).when(eid % 8 == 7, F.concat(F.lit("-"), value))
    for turn, text in odd.items():
        number = number.when(eid % 8 == turn, F.lit(text))
    tg = F.col("tg")
    time = (
        F.when(eid % 7 == 0, tg)
        .when(eid % 7 == 1, F.rtrim(tg, F.lit("Z")))
        .when(eid % 7 == 2, F.concat(F.rtrim(tg, F.lit("Z")), F.lit("7Z")))
        .when(eid % 7 == 3, F.concat(F.rtrim(tg, F.lit("Z")), F.lit("+02:00")))
        .when(eid % 7 == 4, F.substring(tg, 1, 10))
        .when(eid % 7 == 5, F.concat(F.lit("x"), tg))
    )
    return w.base.select("event_id", number.alias("number"), time.alias("time"))


@query
def safe_numeric(w: Workspace) -> DataFrame:
    number = F.col("number")
    as_double = C.safe_double(number)
    return _odd_texts(w).select(
        "event_id",
        F.when(F.isnan(as_double), F.lit("nan")).otherwise(as_double.cast("string")).alias("as_double"),
        C.safe_long(number).alias("as_long"),
    )


@query
def safe_timestamp(w: Workspace) -> DataFrame:
    return _odd_texts(w).select("event_id", F.unix_micros(C.parse_ts(F.col("time"))).alias("micros"))


@query
def props_safe(w: Workspace) -> DataFrame:
    """Property bags of requests and dependencies, and of broken texts cut out of them."""
    text = F.col("Properties")
    broken = F.when(F.length("span_id") % 2 == 0, F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(F.lit("null"))
    bags = w.spans.select("span_id", "name", text.alias("good"), broken.alias("bad"))
    return bags.select(
        "span_id",
        F.size(C.properties_map(F.col("good"))).alias("good_keys"),
        F.size(C.properties_map(F.col("bad"))).alias("bad_keys"),
        C.text_or(C.attr(C.properties_map(F.col("good")), "tool.kind"), "none").alias("tool_kind"),
    )


@query
def props_nested(w: Workspace) -> DataFrame:
    """Event content, a JSON object kept as text inside a property."""
    event = C.nested_map(C.properties_map(F.col("Properties")), "gen_ai.event.content")
    return w.traces.filter(F.col("Message").startswith("gen_ai.")).select(
        "TimeGenerated", "Message", F.size(event).alias("keys"), C.attr(event, "content").alias("content"),
        C.text_or(C.attr(event, "id")).alias("id"),
    )


@query
def assistant_text(w: Workspace) -> DataFrame:
    messages = w.traces.filter(F.col("Message") == M.ASSISTANT)
    event = C.properties_struct(F.col("Properties"), ["gen_ai.event.content"]).getField("gen_ai.event.content")
    return messages.select("TimeGenerated", C.assistant_text(event).alias("text"))


# --- runs -------------------------------------------------------------------------------------


@query
def chat_requests(w: Workspace) -> DataFrame:
    return U.chat_requests(w.requests).withColumn("ts", micros("ts"))


@query
def thread_owner(w: Workspace) -> DataFrame:
    return U.thread_owner(U.chat_requests(w.requests)).select("thread_id", "user_id")


@query
def run_first(w: Workspace) -> DataFrame:
    return U.run_first(U.chat_requests(w.requests)).select("run_id", "thread_id", "start_time", "duration_ms")


@query
def op_run_map(w: Workspace) -> DataFrame:
    return U.operation_runs(U.parse_dependencies(w.dependencies))


@query
def dep_resolve(w: Workspace) -> DataFrame:
    return w.skeleton.resolved.select("id", "run_id", "via")


@query
def run_universe(w: Workspace) -> DataFrame:
    return w.skeleton.runs.select("run_id", "thread_id", "start_time", "from_request", "known_thread")


@query
def run_attrs(w: Workspace) -> DataFrame:
    return U.run_attributes(w.skeleton.resolved)


@query
def tools_extract(w: Workspace) -> DataFrame:
    return X.extract_tools(w.skeleton.resolved).drop("row_id", "ts", "id")


@query
def run_steps_extract(w: Workspace) -> DataFrame:
    return X.extract_steps(w.skeleton.resolved).drop("row_id", "ts", "id")


@query
def tools_attach(w: Workspace) -> DataFrame:
    """Steps after tools are attached, with the number of tools each holds."""
    attached = X.attach_tools(X.extract_steps(w.skeleton.resolved), X.extract_tools(w.skeleton.resolved))
    held = attached.tools.groupBy("run_id", "step_id").agg(F.count(F.lit(1)).alias("tool_count"))
    return attached.steps.join(held, ["run_id", "step_id"], "left").select(
        "run_id", "step_id", "step_type", "start_time", rounded("duration_ms"), "status",
        F.coalesce("tool_count", F.lit(0)).alias("tool_count"),
    )


# --- traces -----------------------------------------------------------------------------------


@query
def trace_kinds(w: Workspace) -> DataFrame:
    return w.traces.groupBy(M.trace_kind(F.col("Message")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query
def user_msg_asof(w: Workspace) -> DataFrame:
    return M.user_message_runs(w.routed, w.skeleton.runs).select("thread_id", micros("ts"), "text", "run_id")


@query
def assistant_first(w: Workspace) -> DataFrame:
    return M.first_texts(M.assistant_messages(w.routed, w.skeleton.runs), "output_message")


@query
def run_completed_asof(w: Workspace) -> DataFrame:
    return M.completion_runs(w.routed, w.skeleton.runs, w.skeleton.owners, w.audits).select(
        "run_id", micros("ts"), "input_tokens", "output_tokens", "total_tokens", "duration_ms", "status"
    )


@query
def audit_assign(w: Workspace) -> DataFrame:
    return w.audits.select(
        "run_id", micros("ts"), "total_tokens", "status", "has_metrics", "agent_id", "input", "output",
        F.col("audit.trace_id").alias("meta_trace"), F.col("audit.span_id").alias("meta_span"),
        F.col("audit.user_id").alias("meta_user"), "audit.input_length", "audit.output_length",
    )


@query
def run_events(w: Workspace) -> DataFrame:
    completions = M.completion_runs(w.routed, w.skeleton.runs, w.skeleton.owners, w.audits)
    return M.all_events(completions, w.audits).select("run_id", micros("ts"), "is_completion", "total_tokens", "status", "agent_id")


@query
def tool_msg_zip(w: Workspace) -> DataFrame:
    tools = X.extract_tools(w.skeleton.resolved)
    fills = M.tool_message_fills(w.routed, tools)
    return fills.join(tools.select("row_id", "tool_id"), "row_id").select("run_id", "tool_id", "nth", "fill")


@query
def extract_counters(w: Workspace) -> DataFrame:
    return A.extraction_counters(w.skeleton, w.routed)


# --- silver tables and reports ----------------------------------------------------------------


@query
def silver_users(w: Workspace) -> DataFrame:
    return w.tables["users"]


@query
def silver_threads(w: Workspace) -> DataFrame:
    return w.tables["threads"].withColumn("duration_ms", rounded("duration_ms"))


@query
def silver_runs(w: Workspace) -> DataFrame:
    return w.tables["runs"].withColumn("duration_ms", rounded("duration_ms"))


@query
def silver_run_steps(w: Workspace) -> DataFrame:
    return w.tables["run_steps"].withColumn("duration_ms", rounded("duration_ms"))


@query
def silver_tools(w: Workspace) -> DataFrame:
    return w.tables["tools"].withColumn("duration_ms", rounded("duration_ms"))


@query
def thread_rollup(w: Workspace) -> DataFrame:
    return w.silver.threads.select(
        "thread_id", "start_time", "end_time", rounded("duration_ms"), *V.TOTALS, "run_count"
    )


@query
def user_rollup(w: Workspace) -> DataFrame:
    return w.silver.users.select("user_id", "total_interactions", "total_tokens")


@query
def summary_global(w: Workspace) -> DataFrame:
    return A.summary(w.silver)


@query
def token_top_runs(w: Workspace) -> DataFrame:
    return A.top_runs_by_tokens(w.tables["runs"])


@query
def token_top_threads(w: Workspace) -> DataFrame:
    return A.top_threads_by_tokens(w.tables["threads"])


@query
def tool_usage(w: Workspace) -> DataFrame:
    return A.tool_usage(w.tables["tools"]).withColumn("avg_duration_ms", rounded("avg_duration_ms"))


@query
def latency_stats(w: Workspace) -> DataFrame:
    names = ("avg_duration_ms", "min_duration_ms", "max_duration_ms")
    return A.latency_stats(w.tables["runs"]).select(*map(rounded, names))


@query
def hierarchy_view(w: Workspace) -> DataFrame:
    return H.hierarchy_view(w.silver).withColumn("duration_ms", rounded("duration_ms"))


# What ``hierarchy_json`` reads of a node; ids of all levels, as a node holds those of its own and of some parents.
_NODE_VALUES = (
    ", ".join(f"{level}_id string" for level in H.LEVELS)
    + ", total_tokens string, duration_ms string, output_full string, metadata struct<user_id:string,operation_name:string>"
)


@query
def hierarchy_json(w: Workspace) -> DataFrame:
    """Values read back out of the JSON text of every node, each text parsed once."""
    # A generator, as values of one parse in a projection would be a parse each.
    parsed = F.inline(F.array(F.from_json("node", _NODE_VALUES, C.JSON_LIMITS)))
    return H.json_nodes(w.silver, staged=False).select("level", "parent_id", parsed).select(
        "level", "parent_id",
        F.coalesce(*[f"{level}_id" for level in reversed(H.LEVELS)]).alias("node_id"),
        F.col("total_tokens").cast("bigint").alias("total_tokens"),
        F.round(F.col("duration_ms").cast("double"), 4).alias("duration_ms"),
        F.col("metadata.user_id").alias("meta_user"),
        F.col("metadata.operation_name").alias("meta_operation"),
        F.length("output_full").alias("output_length"),
    )


def _document_table(w: Workspace, name: str) -> DataFrame:
    """A silver table read back out of the whole nested document."""
    path = stage_path(w.spark, "document")
    H.write_hierarchy_json(w.silver, path)
    return H.read_hierarchy_json(w.spark, path)[name]


@query
def document_users(w: Workspace) -> DataFrame:
    return _document_table(w, "users")


@query
def document_threads(w: Workspace) -> DataFrame:
    return _document_table(w, "threads").withColumn("duration_ms", rounded("duration_ms"))


@query
def document_runs(w: Workspace) -> DataFrame:
    return _document_table(w, "runs").withColumn("duration_ms", rounded("duration_ms"))


@query
def document_run_steps(w: Workspace) -> DataFrame:
    return _document_table(w, "run_steps").withColumn("duration_ms", rounded("duration_ms"))


@query
def document_tools(w: Workspace) -> DataFrame:
    return _document_table(w, "tools").withColumn("duration_ms", rounded("duration_ms"))
