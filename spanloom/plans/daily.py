"""Reports over bronze tables that grow: what was added is reduced once, and a report merges what was reduced.

Each report has a state per key that merges: counts and sums add up, first and last values are minima and
maxima of (order, value). ``add`` reads the files that no earlier call has read, such as those of a new
day, and writes their states as one unit; reports read the states of all units and no bronze row. The list
of files that a unit covers is written last, and a unit without it does not count, so a call that breaks
off can be repeated.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schemas import bronze_schema
from .reports import CHAT
from .runs import chat_requests, parse_dependencies
from .spans import dependency_spans, request_spans, with_attributes

SOURCES = ("app_requests", "app_dependencies")


class State(NamedTuple):
    """``rows`` gives the input of one source, ``parts`` its aggregates per ``keys``; ``merge`` combines parts of one name."""

    keys: list[str]
    sources: dict[str, Callable[[DataFrame], DataFrame]]
    parts: dict[str, Column]
    merge: dict[str, Callable[[Column], Column]]
    result: list[Column | str]


def _spans(shape: Callable[[DataFrame], DataFrame], wanted: list[str], required: str | None = None) -> Callable[[DataFrame], DataFrame]:
    return lambda rows: with_attributes(shape(rows), wanted, required)


def _chats(rows: DataFrame) -> DataFrame:
    return with_attributes(request_spans(rows).filter(F.col("name") == CHAT), ["user_id"])


def _named_operations(rows: DataFrame) -> DataFrame:
    return parse_dependencies(rows).filter(F.col("own_run").isNotNull() & F.col("operation_id").isNotNull())


def states() -> dict[str, State]:
    """State of each report by name (columns need a session, so this is no constant)."""
    thread = ["thread_id", "tokens_total"]
    return {
        "users_active": State(
            ["user_id"], {"app_requests": _chats, "app_dependencies": lambda rows: with_attributes(dependency_spans(rows).filter(F.col("name") == CHAT), ["user_id"])},
            {"total_requests": F.count(F.lit(1))}, {"total_requests": F.sum}, ["user_id", "total_requests"],
        ),
        "threads_summary": State(
            ["thread_id"],
            {"app_requests": _spans(request_spans, thread, "thread_id"), "app_dependencies": _spans(dependency_spans, thread, "thread_id")},
            {"interacciones": F.count(F.when(F.col("name") == CHAT, 1)), "tokens_consumidos": F.sum("tokens_total"), "ultimo_mensaje": F.max("timestamp")},
            {"interacciones": F.sum, "tokens_consumidos": F.sum, "ultimo_mensaje": F.max},
            ["thread_id", "interacciones", "tokens_consumidos", "ultimo_mensaje"],
        ),
        "thread_owner": State(
            ["thread_id"], {"app_requests": chat_requests}, {"first": F.min(F.struct("ts", "request_id", "user_id"))}, {"first": F.min},
            ["thread_id", "first.user_id"],
        ),
        "run_first": State(
            ["run_id"], {"app_requests": lambda rows: chat_requests(rows).filter(F.col("run_id") != "")},
            {"first": F.min(F.struct("ts", "request_id", "thread_id", "start_time", "duration_ms"))}, {"first": F.min},
            ["run_id", "first.thread_id", "first.start_time", "first.duration_ms"],
        ),
        "op_run_map": State(
            ["operation_id"], {"app_dependencies": _named_operations}, {"last": F.max(F.struct("ts", "id", F.col("own_run").alias("run")))}, {"last": F.max},
            ["operation_id", F.col("last.run").alias("operation_run")],
        ),
    }


class DailyStates:
    """States of all reports under ``root``, over bronze folders that are given with each call."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _folder(self, name: str) -> DataFrame | None:
        """What the units have written under ``name``; None before the first."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        files = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return self.spark.read.parquet(f"{self.root}/{name}") if files.exists(path) else None

    def covered(self) -> DataFrame:
        """``source``, ``file`` and ``unit`` of every file read so far."""
        found = self._folder("covered")
        return found if found is not None else self.spark.createDataFrame([], "source string, file string, unit int")

    def new_files(self, bronze: dict[str, str]) -> dict[str, list[str]]:
        """Files of each source folder that no unit covers."""
        known = {(r["source"], r["file"]) for r in self.covered().select("source", "file").collect()}
        found = {}
        for source, path in bronze.items():
            files = self.spark.read.schema(bronze_schema(source)).parquet(path).inputFiles()
            found[source] = [f for f in files if (source, f) not in known]
        return found

    def add(self, bronze: dict[str, str]) -> list[str]:
        """Reduce the new files of the ``bronze`` folders (source -> path) as one unit; returns those files."""
        new = self.new_files(bronze)
        if not any(new.values()):
            return []
        unit = self.covered().agg(F.coalesce(F.max("unit") + 1, F.lit(0))).first()[0]
        rows = {
            source: self.spark.read.schema(bronze_schema(source)).option("basePath", bronze[source]).parquet(*files)
            for source, files in new.items() if files
        }
        for name, state in states().items():
            found = None
            for source, shape in state.sources.items():
                if source in rows:
                    part = shape(rows[source]).groupBy(*state.keys).agg(*[c.alias(n) for n, c in state.parts.items()])
                    found = part if found is None else found.unionByName(part)
            if found is not None:
                found.write.mode("overwrite").parquet(f"{self.root}/{name}/unit={unit}")
        listed = [(source, f) for source, files in new.items() for f in files]
        self.spark.createDataFrame(listed, "source string, file string").write.mode("overwrite").parquet(f"{self.root}/covered/unit={unit}")
        return [f for _, f in listed]

    def report(self, name: str) -> DataFrame:
        """A report over all that was added: one merge of its states."""
        state, parts = states()[name], self._folder(name)
        if parts is None:
            raise ValueError(f"nothing was added that {name} reads")
        done = self.covered().select("unit").distinct()
        merged = parts.join(F.broadcast(done), "unit", "left_semi").groupBy(*state.keys).agg(
            *[state.merge[n](F.col(n)).alias(n) for n in state.parts]
        )
        return merged.select(*state.result)
