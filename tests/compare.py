"""Row-for-row comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def spark_rows(frame):
    order = sorted(range(len(frame.columns)), key=lambda i: frame.columns[i])
    return sorted(frame.columns), Counter(tuple(plain(r[i]) for i in order) for r in frame.collect())


def duck_rows(connection, sql):
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(plain(r[i]) for i in order) for r in cursor.fetchall())


def difference(frame, connection, sql) -> str | None:
    """None if equal, else a short account of the difference."""
    mine, left = spark_rows(frame)
    theirs, right = duck_rows(connection, sql)
    if mine != theirs:
        return f"columns {mine} != {theirs}"
    if left == right:
        return None
    extra, missing = left - right, right - left
    return (
        f"rows {sum(left.values())} vs {sum(right.values())}, {sum(extra.values())} extra, "
        f"{sum(missing.values())} missing\n  extra {list(extra)[:2]}\n  missing {list(missing)[:2]}"
    )
