"""Run a registered query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    return value


def _rows(names: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark: SparkSession, connection: duckdb.DuckDBPyConnection, folder: str, name: str) -> str | None:
    """None if both agree on columns and rows, else what differs."""
    return frame_differences(QUERIES[name](spark, folder), connection, name)


def frame_differences(frame: DataFrame, connection: duckdb.DuckDBPyConnection, name: str) -> str | None:
    ours = _rows(frame.columns, frame.collect())
    result = connection.execute(ORACLE[name])
    theirs = _rows([column[0] for column in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if ours[1] != theirs[1]:
        left, right = list((ours[1] - theirs[1]).items())[:2], list((theirs[1] - ours[1]).items())[:2]
        return f"{ours[1].total()} vs {theirs[1].total()} rows; only ours {left}; only SQL {right}"
    return None
