"""Stage boundaries: write an intermediate result once to shared storage and read it back.

A stage is the durable form of ``checkpoint()``: it cuts lineage, survives the loss of any
executor, and, being columnar, lets every later reader fetch only the columns it needs.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.util import inheritable_thread_target


def stage_root(spark: SparkSession) -> str:
    """Folder for staged tables: ``spark.checkpoint.dir``, else the context's checkpoint folder.

    Without either it is a folder of this application in the warehouse. A warehouse on a local disk is not
    shared between the machines of a cluster, so it is refused there.
    """
    context = spark.sparkContext
    root = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
    )
    if root:
        return root.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    path = context._jvm.org.apache.hadoop.fs.Path(warehouse)
    scheme = path.getFileSystem(context._jsc.hadoopConfiguration()).getScheme()
    if scheme == "file" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share: the warehouse is a local folder")
    return f"{warehouse}/_stages-{context.applicationId}"


# Paths written inside a scope, and the thread whose stages it takes (None: of all).
_scopes: list[tuple[list[str], int | None]] = []


@contextmanager
def temporary_stages(spark: SparkSession, own_thread: bool = False) -> Iterator[None]:
    """Stages written inside are removed at the end: write the outputs that read them inside too.

    With ``own_thread`` only those that this thread writes, so that other work of the application keeps its own.
    """
    own: list[str] = []
    scope = (own, threading.get_ident() if own_thread else None)
    _scopes.append(scope)
    try:
        yield
    finally:
        _scopes[:] = [s for s in _scopes if s is not scope]
        context = spark.sparkContext
        for name in own:
            path = context._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def stage_path(spark: SparkSession, label: str) -> str:
    path = f"{stage_root(spark)}/{label}-{uuid.uuid4().hex}"
    for own, thread in _scopes:
        if thread in (None, threading.get_ident()):
            own.append(path)
    return path


def stage(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to a new staged table and return a scan of it."""
    return _written(df, stage_path(df.sparkSession, label), partition_by)


def _written(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def stage_alone(spark: SparkSession, build: Callable[[], DataFrame], label: str) -> DataFrame:
    """The stage of what ``build`` returns; stages that ``build`` wrote on the way are removed once it is written."""
    path = stage_path(spark, label)
    with temporary_stages(spark, own_thread=True):
        return _written(build(), path)


def together(*builders: Callable[[], object]) -> list:
    """Results of independent builders whose stages are written at the same time.

    Spark runs jobs of several threads side by side, so the last tasks of one stage do not leave
    the cluster idle.
    """
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(len(builders)) as pool:
        return [f.result() for f in [pool.submit(inherit(b)) for b in builders]]
