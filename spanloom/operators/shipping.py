"""Code for Python workers: executors need not have this package installed."""

from __future__ import annotations

import io
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from .staging import stage_root

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the workers of this application, once; later calls do nothing."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    name = f"{stage_root(spark)}/{package.name}-{uuid.uuid4().hex}.zip"
    path = context._jvm.org.apache.hadoop.fs.Path(name)
    out = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path, False)
    try:
        out.write(bytearray(packed.getvalue()))
    finally:
        out.close()
    context.addPyFile(name)
    _shipped.add(context.applicationId)
