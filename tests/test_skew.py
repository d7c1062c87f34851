"""One user holds over a third of the events, nearly all in one day and thread; every chunk is kept apart."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from oracle.queries import oracle_sql
from spanloom.catalog import QUERIES, Workspace
from spanloom.operators.ordered import CHUNK, order_chunks

from .compare import oracle_result, spark_result

NAMES = ["span_fill", "dep_resolve", "user_msg_asof", "run_completed_asof", "run_events", "tool_msg_zip",
         "silver_runs", "silver_tools", "silver_threads", "hierarchy_json"]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    hot = F.col("event_id") % 5 < 2
    moved = F.make_timestamp_ntz(
        F.lit(2024), F.lit(1), F.lit(3), (F.col("event_id") % 24).cast("int"), (F.col("event_id") % 60).cast("int"),
        (F.col("event_id") % 60 + F.col("event_id") / 1_000_000).cast("decimal(16,6)"),
    )
    events.withColumns({
        "user_id": F.when(hot, F.lit(7).cast("bigint")).otherwise(F.col("user_id")),
        "ts": F.when(hot, moved).otherwise(F.col("ts")),
    }).write.parquet(f"{folder}/events.parquet")
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{folder}/events.parquet/*.parquet'")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield Workspace(spark, str(folder)), con
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_hot_thread_is_cut(skewed):
    workspace, _ = skewed
    cut = order_chunks(workspace.base, ["user_id", "week"], ["ts", "event_id"])
    chunks = cut.filter("user_id = 7").select(CHUNK).distinct().count()
    assert chunks >= 3


@pytest.mark.parametrize("name", NAMES)
def test_query(name, skewed):
    workspace, con = skewed
    assert spark_result(QUERIES[name](workspace)) == oracle_result(con, oracle_sql()[name])
