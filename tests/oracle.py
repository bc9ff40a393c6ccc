"""Compare named queries with their SQL, row by row and without tolerance."""

from __future__ import annotations

import datetime
import decimal
import glob
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(os.path.join(folder, "*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if value is None:
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    return str(value)


def canonical(names: list[str], rows: list[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark_df, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    expected = canonical(names, cursor.fetchall())
    found = canonical(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    if len(found) != len(expected):
        return f"{len(found)} rows, expected {len(expected)}; e.g. {found[:1]} / {expected[:1]}"
    wrong = [(a, b) for a, b in zip(found, expected) if a != b]
    return f"{len(wrong)} of {len(expected)} rows differ, e.g. {wrong[0]}" if wrong else None
