"""Versions of a bronze table: writes are seen whole or not at all."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from spanloom.schemas import BRONZE_COLUMNS
from spanloom.sinks import bronze
from spanloom.sinks.versions import Conflict, VersionedTable

TIMES = ["2024-01-01T10:00:00Z", "2024-01-02T10:00:00Z", "2024-01-02T20:00:00Z", "unknown", "2024-01-03T00:00:00Z", "2024-01-01T00:00:00Z"]
DAYS = ["2024-01-01", "2024-01-02", "2024-01-02", "2024-01-02", "2024-01-03", None]


@pytest.fixture
def full(spark):
    rows = spark.createDataFrame(list(zip("abcdef", TIMES, DAYS, strict=True)), "Id string, TimeGenerated string, date_routine string")
    return rows.select(*[(F.col(c) if c in rows.columns else F.lit(None).cast("string")).alias(c) for c in BRONZE_COLUMNS["app_requests"]])


def ids(df):
    return "".join(sorted(r.Id for r in df.collect()))


def test_overwrite_purge_and_old_versions(spark, tmp_path, full):
    table = VersionedTable(spark, str(tmp_path / "t"), "app_requests")
    assert table.versions() == [] and table.read().count() == 0 and table.purge("2024-01-02T12:00:00Z") == 0
    assert table.overwrite(full) == 1 and ids(table.read()) == "abcdef"
    assert table.purge("2024-01-02T12:00:00Z") == 2 and ids(table.read()) == "cde"
    assert table.purge("2024-01-02T12:00:00Z") == 2  # nothing left to drop: no new version
    assert ids(table.read(1)) == "abcdef"
    assert table.overwrite(full.filter("Id in ('a', 'f')")) == 3 and ids(table.read()) == "af"
    assert {r.Id: r.date_routine for r in table.read().collect()} == {"a": "2024-01-01", "f": None}
    assert table.overwrite(full.limit(0)) == 4 and table.read().count() == 0
    assert table.read().columns == BRONZE_COLUMNS["app_requests"]


def test_untouched_dates_are_not_written_again(spark, tmp_path, full):
    table = VersionedTable(spark, str(tmp_path / "t"), "app_requests")
    table.overwrite(full)
    before = table._dates(1)
    table.purge("2024-01-02T12:00:00Z")
    after = table._dates(2)
    assert after["2024-01-03"] == before["2024-01-03"] and after["2024-01-02"] != before["2024-01-02"]
    assert set(after) == {"2024-01-02", "2024-01-03"}


@pytest.mark.parametrize("step", ["rows", "manifest"])
def test_a_write_that_breaks_off_changes_nothing(spark, tmp_path, full, monkeypatch, step):
    """Failure in the midst of the dates of a purge, or just before the new version is named."""
    table = VersionedTable(spark, str(tmp_path / "t"), "app_requests")
    table.overwrite(full)
    broken = VersionedTable(spark, str(tmp_path / "t"), "app_requests")
    if step == "rows":
        late = F.when(F.col("date_routine") == "2024-01-02", F.raise_error(F.lit("killed"))).otherwise(F.col("Id"))
        monkeypatch.setattr("spanloom.sinks.versions.retained", lambda df, cutoff: bronze.retained(df, cutoff).withColumn("Id", late.cast("string")))
    else:
        monkeypatch.setattr(broken, "_publish", lambda *args: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(Exception, match="killed"):
        broken.purge("2024-01-02T12:00:00Z")
    monkeypatch.undo()
    assert table.versions() == [1] and ids(table.read()) == "abcdef"
    assert table.purge("2024-01-02T12:00:00Z") == 2 and ids(table.read()) == "cde"
    gone = table.vacuum()
    assert bool(gone) == (step == "manifest") and table.versions() == [2] and ids(table.read()) == "cde"
    assert {p.name for p in (tmp_path / "t").iterdir()} == {"_manifests", *table._dates(2).values()}


def test_one_of_two_writers_wins(spark, tmp_path, full):
    first, second = (VersionedTable(spark, str(tmp_path / "t"), "app_requests") for _ in range(2))
    first.overwrite(full)
    claimed, rows = second._last_claim(), second._write(full.filter("Id = 'a'"))
    first.overwrite(full.filter("Id = 'b'"))
    with pytest.raises(Conflict):
        second._publish(claimed, rows)
    assert ids(first.read()) == "b"


def test_delta_purge_deletes_the_stale_times(spark, full, monkeypatch):
    """The statement sent for a Delta table, applied to a view that stands in for the table."""
    full.createOrReplaceTempView("delta_stand_in")
    plain, kept = spark.sql, []

    def sql(text, *args, **kwargs):
        if not text.startswith("DELETE"):
            return plain(text, *args, **kwargs)
        assert text.startswith("DELETE FROM delta_stand_in WHERE ")
        rule = text.split(" WHERE ", 1)[1]
        kept.append(ids(plain(f"SELECT * FROM delta_stand_in WHERE NOT coalesce({rule}, false)")))

    monkeypatch.setattr(spark, "sql", sql)
    bronze.purge(spark, ["delta_stand_in"], "2024-01-02T12:00:00Z", fmt="delta")
    assert kept == ["cde"]
