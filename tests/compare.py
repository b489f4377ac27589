"""Order-free comparison of a Spark result with the SQL answer on the same tables."""

from __future__ import annotations

import datetime
import decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    return value


def _lines(names: list[str], rows) -> list[str]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([_plain(row[i]) for i in order]) for row in rows)


SAME_TYPE = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
}


def differences(result, connection, sql: str) -> str | None:
    """None when both have the same columns, types and rows, else what differs."""
    answer = connection.execute(sql)
    names = [d[0] for d in answer.description]
    types = {d[0]: str(d[1]) for d in answer.description}
    if sorted(result.columns) != sorted(names):
        return f"columns {sorted(result.columns)} and {sorted(names)}"
    wrong = {c: (t, types[c]) for c, t in result.dtypes if SAME_TYPE.get(t) != types[c]}
    if wrong:
        return f"types {wrong}"
    ours = _lines(result.columns, result.collect())
    theirs = _lines(names, answer.fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} and {len(theirs)} rows"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"row {a} and {b}"
    return None
