"""Every registered query against its DuckDB oracle. Queries share one workspace here."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from spanloom.catalog import QUERIES, Workspace

from .compare import connect, oracle_result, spark_result, type_differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def workspace(spark):
    return Workspace(spark, SF_DIR)


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, workspace, duck):
    sql = oracle_sql()[name]
    df = QUERIES[name](workspace)
    assert spark_result(df) == oracle_result(duck, sql)
    assert type_differences(df, duck, sql) == []
