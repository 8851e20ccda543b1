"""Compare a Spark result with the result of SQL in DuckDB: columns by name, rows in any order."""

from __future__ import annotations

import collections
import datetime
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{os.path.join(sf_dir, name)}.parquet'")
    return con


def _plain(value):
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    bag = collections.Counter(tuple(_plain(row[i]) for i in order) for row in rows)
    return [names[i] for i in order], bag


def differences(spark_df, con, sql: str) -> list[str]:
    found = con.execute(sql)
    names, expected = _bag([d[0] for d in found.description], found.fetchall())
    got_names, got = _bag(spark_df.columns, (tuple(r) for r in spark_df.collect()))
    if got_names != names:
        return [f"columns {got_names} instead of {names}"]
    out = []
    if sum(got.values()) != sum(expected.values()):
        out.append(f"{sum(got.values())} rows instead of {sum(expected.values())}")
    missing, extra = expected - got, got - expected
    if missing:
        out.append(f"missing {list(missing)[:3]}")
    if extra:
        out.append(f"extra {list(extra)[:3]}")
    return out
