"""Comparing a query with its flat SQL: same columns, same rows, in any order."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "<null>"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return f"{value:.6g}" if not value.is_integer() else str(int(value))
    return str(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_rows(df):
    table = df.toArrow()
    return normal(table.column_names, list(zip(*[c.to_pylist() for c in table.columns], strict=True)))


def duck_rows(con, sql):
    result = con.execute(sql)
    return normal([d[0] for d in result.description], result.fetchall())


def difference(df, con, sql) -> str | None:
    """None when equal, else a short description."""
    names, got = spark_rows(df)
    wanted_names, wanted = duck_rows(con, sql)
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    if got != wanted:
        extra = list(set(got) - set(wanted))[:3]
        lost = list(set(wanted) - set(got))[:3]
        return f"{len(got)} rows, expected {len(wanted)}; extra {extra}; lost {lost}"
    return None
