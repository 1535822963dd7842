"""Run a query in Spark and its SQL in DuckDB and compare rows, whatever their order."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, sql: str, connection) -> str | None:
    """None if both sides agree, otherwise what differs first."""
    columns = df.columns
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(columns) != sorted(names):
        return f"columns {sorted(columns)} against {sorted(names)}"
    spark_rows = rows_of(columns, [tuple(r) for r in df.collect()])
    sql_rows = rows_of(names, result.fetchall())
    if len(spark_rows) != len(sql_rows):
        return f"{len(spark_rows)} rows against {len(sql_rows)}"
    for left, right in zip(spark_rows, sql_rows):
        if left != right or [type(v) for v in left] != [type(v) for v in right]:
            return f"{sorted(names)}: {str(left)[:600]} against {str(right)[:600]}"
    return None
