"""Compare a Spark result with the same query's result in DuckDB."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

GIVEN_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for table in GIVEN_TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return value.normalize() if value else Decimal(0)
    if hasattr(value, "tolist"):
        return tuple(value.tolist())
    return tuple(value) if isinstance(value, list) else value


def _rows(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


TYPE_NAMES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs in names, types, row count or values; empty when equal."""
    found = []
    answer = con.execute(sql)
    names = [column[0] for column in answer.description]
    expected_rows = answer.fetchall()
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} expected {sorted(names)}"]
    described = con.execute(f"describe {sql}").fetchall()
    expected_types = {row[0]: row[1] for row in described}
    for name, kind in df.dtypes:
        wanted = TYPE_NAMES.get(kind, kind.upper())
        if wanted != expected_types[name].replace(" ", ""):
            found.append(f"type of {name}: {kind} expected {expected_types[name]}")
    actual = _rows(df.columns, [tuple(row) for row in df.collect()])
    expected = _rows(names, expected_rows)
    if actual.total() != expected.total():
        found.append(f"{actual.total()} rows, expected {expected.total()}")
    if actual != expected:
        extra, missing = actual - expected, expected - actual
        found.append(f"extra {list(extra)[:2]} missing {list(missing)[:2]}")
    return found
