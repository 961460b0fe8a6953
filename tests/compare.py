"""Compare every query with its SQL counterpart in an in-process DuckDB."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _key(row):
    return tuple((value is None, str(type(value)), value if value is not None else 0) for value in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda place: columns[place])
    return sorted([tuple(row[place] for place in order) for row in rows], key=_key)


def difference(spark_df, connection, sql: str) -> str | None:
    """``None`` if both sides agree in columns, types of numbers, row count and exact values."""
    answer = connection.execute(sql)
    columns = [entry[0] for entry in answer.description]
    expected = answer.fetchall()
    got = spark_df.collect()
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(columns)}"
    if len(got) != len(expected):
        return f"rows {len(got)} != {len(expected)}"
    left, right = rows_of(spark_df.columns, got), rows_of(columns, expected)
    for a, b in zip(left, right):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} != {b}"
        if any(isinstance(x, float) and math.isnan(x) for x in a):
            return f"NaN in {a}"
    return None
