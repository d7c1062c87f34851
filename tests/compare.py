"""Compare every registered query with its oracle: ``python -m tests.compare [sf] [name ...]``."""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _key(value):
    if value is None:
        return "\0"
    if isinstance(value, float):
        return repr(value)
    return str(value)


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple[str, ...]]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_key(r[i]) for i in order) for r in rows)


def spark_result(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def oracle_result(con, sql: str):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return canonical(columns, cursor.fetchall())


# Spark type -> DuckDB type
TYPE_NAMES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def type_differences(df, con, sql: str) -> list[tuple[str, str, str]]:
    spark_types = {name: TYPE_NAMES.get(kind, kind) for name, kind in df.dtypes}
    wanted = {row[0]: row[1] for row in con.execute(f"describe {sql}").fetchall()}
    return [(c, t, wanted.get(c, "-")) for c, t in spark_types.items() if wanted.get(c) != t]


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import make_session

    sf, names = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con, oracle = make_session(), connect(sf_dir), oracle_sql()
    bad = []
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            columns, got = spark_result(df)
            took = time.time() - start
            wanted_columns, wanted = oracle_result(con, oracle[name])
        except Exception as error:  # report and go on with the next query
            print(f"FAIL {name}: {str(error)[:1500]}", flush=True)
            bad.append(name)
            continue
        same = columns == wanted_columns and got == wanted
        types = type_differences(df, con, oracle[name])
        if types:
            print(f"TYPE {name}: {types}", flush=True)
        print(f"{'ok  ' if same else 'DIFF'} {name} rows={len(got)}/{len(wanted)} {took:.1f}s", flush=True)
        if not same:
            bad.append(name)
            print("   ", columns, wanted_columns)
            extra, missing = set(got) - set(wanted), set(wanted) - set(got)
            print("    spark only:", sorted(extra)[:3], "\n    oracle only:", sorted(missing)[:3])
    print("bad:", bad)


if __name__ == "__main__":
    main()
