"""Time the headline queries from staged bronze tables; prints one JSON line.

``BENCH_SF_DIR`` is the folder of the driver's tables, ``BENCH_CPUS`` the number of local cores.
Every query is run once to warm up and then timed ``BENCH_RUNS`` times into the noop sink; the
median counts. ``silver_build`` is the whole model from bronze; the reports after it read it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from spanloom.catalog import QUERIES, Workspace  # noqa: E402

FROM_BRONZE = [
    "users_active", "threads_summary", "interactions", "tool_calls", "audit_log", "span_attrs", "span_fill",
    "chat_requests", "thread_owner", "trace_kinds", "table_profile", "retention_keep",
]
LOADS = [
    "export_unpack", "csv_roundtrip", "bronze_overwrite", "bronze_date", "scan_all", "span_union", "props_safe", "props_nested",
    "safe_numeric", "safe_timestamp", "assistant_text", "export_ranges", "csv_ranges", "bronze_versions",
]
FROM_SKELETON = ["op_run_map", "run_attrs", "tools_attach", "user_msg_asof", "run_completed_asof", "audit_assign", "tool_msg_zip"]
MORE_FROM_SKELETON = ["run_first", "dep_resolve", "run_universe", "tools_extract", "run_steps_extract", "assistant_first", "extract_counters"]
MORE_FROM_SILVER = ["run_events", "thread_rollup", "user_rollup", "span_store_fill", "run_store_attrs"]
FROM_SILVER = [
    "silver_users", "silver_threads", "silver_runs", "silver_run_steps", "silver_tools", "summary_global",
    "token_top_runs", "token_top_threads", "tool_usage", "latency_stats", "hierarchy_view", "hierarchy_json",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("spanloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(os.environ.get("BENCH_CPUS", "8"))

    def median(action) -> float:
        action()
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            action()
            times.append(time.perf_counter() - start)
        return round(statistics.median(times), 4)

    bronze = Workspace(spark, sf_dir)
    bronze.stage_bronze()
    queries: dict[str, float] = {}

    def stage_spans():
        bronze.__dict__.pop("span_table", None)
        return bronze.span_table

    def run_query(name: str):
        return lambda: QUERIES[name](bronze).write.format("noop").mode("overwrite").save()

    def rebuild(part: str):
        def action() -> None:
            for cached in (part, "tables"):
                bronze.__dict__.pop(cached, None)
            getattr(bronze, part)
        return action

    for name in LOADS:
        queries[name] = median(run_query(name))
    queries["span_table_build"] = median(stage_spans)
    for name in FROM_BRONZE:
        queries[name] = median(run_query(name))
    queries["skeleton_build"] = median(rebuild("skeleton"))
    queries["traces_build"] = median(rebuild("routed"))
    for name in FROM_SKELETON + MORE_FROM_SKELETON:
        queries[name] = median(run_query(name))
    queries["silver_build"] = median(rebuild("silver"))
    for name in FROM_SILVER + MORE_FROM_SILVER:
        queries[name] = median(run_query(name))
    # Queries that the baseline does not list are timed as well, but stay out of the sum.
    added = {*LOADS, "span_table_build", *MORE_FROM_SKELETON, *MORE_FROM_SILVER}
    print(json.dumps({
        "metric": "sum of median query times", "value": round(sum(t for q, t in queries.items() if q not in added), 3), "unit": "sec",
        "queries": queries, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
