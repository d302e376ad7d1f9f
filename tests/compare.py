"""Comparing a Spark result with that of its SQL check."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duckdb_views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value + 0.0:.9g}"
    if isinstance(value, decimal.Decimal):
        return canonical(float(value))
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat(timespec="microseconds")
    if isinstance(value, (list, tuple)):
        return tuple(canonical(v) for v in value)
    return str(value)


def canonical_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(row[i]) for i in order) for row in rows)


def spark_rows(df: DataFrame):
    return sorted(df.columns), canonical_rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(connection, sql: str):
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), canonical_rows(columns, result.fetchall())
