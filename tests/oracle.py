"""Comparison of a Spark result with its DuckDB result as multisets of rows."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """DuckDB with the test tables as views."""
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def rows_of_spark(df) -> tuple[list[str], Counter]:
    """Sorted column names, and the rows in that column order."""
    names = sorted(df.columns)
    return names, Counter(tuple(row) for row in df.select([f"`{n}`" for n in names]).collect())


def rows_of_duckdb(connection, sql: str) -> tuple[list[str], Counter]:
    """Sorted column names, and the rows in that column order."""
    result = connection.execute(sql)
    columns = [c[0] for c in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(
        tuple(row[i] for i in order) for row in result.fetchall()
    )
