"""Run a query on Spark and its SQL on DuckDB and compare names, types and all rows."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal

import duckdb

RAW_TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

TYPE_NAMES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "binary": "BLOB",
    "double": "DOUBLE",
}


def duckdb_over(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in RAW_TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    return format(value, "f") if isinstance(value, Decimal) else value


def _bag(rows, columns) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    answer = con.execute(sql)
    theirs = {d[0]: str(d[1]).replace(" ", "") for d in answer.description}
    ours = {name: TYPE_NAMES.get(kind, kind.upper()) for name, kind in df.dtypes}
    found = []
    if ours != theirs:
        found.append(f"schema: {sorted(ours.items() ^ theirs.items())}")
    if set(ours) != set(theirs):
        return found
    left = _bag(df.collect(), df.columns)
    right = _bag(answer.fetchall(), list(theirs))
    if left != right:
        found.append(f"rows: {left.total()} against {right.total()}; only ours {list((left - right).items())[:2]}; only theirs {list((right - left).items())[:2]}")
    return found
