"""Bronze tables in versions: a reader sees all of a write or nothing of it.

A write puts its rows into a folder of its own and then adds one small manifest, which names the folder
of every date of the table. Moving the complete manifest into place is the only step that readers
notice. A write that breaks off leaves a folder that no manifest names; ``vacuum`` removes those.
A number is claimed by creating a file where there is none, so two writers from one version cannot
both succeed. A writer that dies between claim and move leaves its number unused; the next goes on after it.

    root/_manifests/00000007.json    {"dates": {"2024-01-02": "1f0c..", "2024-01-03": "88ab.."}}
    root/1f0c../date_routine=2024-01-02/part-..
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.scalars import parse_ts
from ..schemas import PARTITION_COLUMN, bronze_schema
from .bronze import readable_cutoff, retained

# Fixed value: the folder of rows whose partition date is NULL.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


class Conflict(RuntimeError):
    """Another write has made the version that this one was about to make."""


class VersionedTable:
    """One bronze table under ``root``. A version's dates are bounded by the calendar, and so is its manifest."""

    def __init__(self, spark: SparkSession, root: str, table: str) -> None:
        self.spark, self.root, self.schema = spark, root.rstrip("/"), bronze_schema(table)

    def _path(self, *parts: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    @property
    def _files(self):
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Numbers of the versions that are kept, oldest first."""
        folder = self._path("_manifests")
        if not self._files.exists(folder):
            return []
        names = (s.getPath().getName() for s in self._files.listStatus(folder))
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _last_claim(self) -> int:
        """The highest number that any writer has claimed, 0 before the first."""
        folder = self._path("_manifests")
        if not self._files.exists(folder):
            return 0
        names = (s.getPath().getName() for s in self._files.listStatus(folder))
        return max((int(n.split(".")[0]) for n in names if not n.startswith(".")), default=0)

    def _dates(self, version: int) -> dict[str, str]:
        text = self.spark.read.text(str(self._path("_manifests", f"{version:08d}.json")), wholetext=True).first()["value"]
        return json.loads(text)["dates"]

    def _publish(self, after: int, dates: dict[str, str]) -> int:
        """Add the manifest of version ``after`` + 1: claim the number, then move the complete file into place."""
        number = after + 1
        ready, place = self._path("_manifests", f".{uuid.uuid4().hex}"), self._path("_manifests", f"{number:08d}.json")
        out = self._files.create(ready, False)
        try:
            out.write(bytearray(json.dumps({"dates": dates}).encode()))
        finally:
            out.close()
        try:
            taken = self._files.create(self._path("_manifests", f"{number:08d}.claim"), False)
            taken.close()
        except Py4JJavaError as error:
            self._files.delete(ready, False)
            raise Conflict(f"version {number} of {self.root} exists") from error
        if not self._files.rename(ready, place):
            raise Conflict(f"version {number} of {self.root} exists")
        return number

    def _write(self, df: DataFrame) -> dict[str, str]:
        """Write rows to a new folder; the folder by date."""
        folder = uuid.uuid4().hex
        rows = df.select(self.schema.names).hint("rebalance", PARTITION_COLUMN)
        rows.write.partitionBy(PARTITION_COLUMN).parquet(str(self._path(folder)))
        found = (s.getPath().getName() for s in self._files.listStatus(self._path(folder)) if s.isDirectory())
        unescape = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        return {unescape(n.removeprefix(f"{PARTITION_COLUMN}=")): folder for n in found if n.startswith(PARTITION_COLUMN)}

    def read(self, version: int | None = None) -> DataFrame:
        """Rows of a version, the last by default; a table without one is empty."""
        known = self.versions()
        if version is None and not known:
            return self.spark.createDataFrame([], self.schema)
        dates = self._dates(known[-1] if version is None else version)
        rows = self.spark.createDataFrame([], self.schema)
        escape = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        for folder in sorted(set(dates.values())):
            own = [str(self._path(folder, f"{PARTITION_COLUMN}={escape(d)}")) for d, f in dates.items() if f == folder]
            part = self.spark.read.schema(self.schema).option("basePath", str(self._path(folder))).parquet(*own)
            rows = rows.unionByName(part.select(self.schema.names))
        return rows

    def overwrite(self, df: DataFrame) -> int:
        """Replace all rows; returns the new version's number."""
        claimed = self._last_claim()
        return self._publish(claimed, self._write(df))

    def purge(self, cutoff: str) -> int:
        """Drop rows older than ``cutoff``, by the rule of ``retained``; returns the version that holds without them.

        Only the dates that hold such rows are written anew, and all of them change at once.
        """
        limit, claimed = readable_cutoff(self.spark, cutoff), self._last_claim()
        before = max(self.versions(), default=0)
        if not before:
            return 0
        rows = self.read(before)
        touched = {r[0] for r in rows.filter(parse_ts(F.col("TimeGenerated")) < limit).select(PARTITION_COLUMN).distinct().collect()}
        if not touched:
            return before
        own = F.col(PARTITION_COLUMN).isin([d for d in touched if d is not None])
        if None in touched:
            own = F.coalesce(own, F.lit(False)) | F.col(PARTITION_COLUMN).isNull()
        untouched = {d: f for d, f in self._dates(before).items() if (None if d == NO_DATE else d) not in touched}
        return self._publish(claimed, untouched | self._write(retained(rows.filter(own), cutoff)))

    def vacuum(self, keep: int = 1) -> list[str]:
        """Remove all but the last ``keep`` versions and the folders that none of those names; run it while nothing is written."""
        known = self.versions()
        kept = known[-keep:]
        named = {folder for v in kept for folder in self._dates(v).values()}
        for v in known[:-keep]:
            self._files.delete(self._path("_manifests", f"{v:08d}.json"), False)
        gone = []
        for status in self._files.listStatus(self._path()):
            name = status.getPath().getName()
            if status.isDirectory() and name != "_manifests" and name not in named:
                self._files.delete(status.getPath(), True)
                gone.append(name)
        return gone
