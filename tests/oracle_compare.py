"""Run a query on Spark and its SQL on DuckDB and compare all values."""

from __future__ import annotations

import decimal
from pathlib import Path

import duckdb


def tables(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return f"d{value:f}"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return f"f{value!r}"
    return f"{type(value).__name__[0]}{value}"


def normal_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, name, query, sql, folder):
    found = query(spark, folder)
    spark_side = normal_rows(found.columns, [tuple(row) for row in found.collect()])
    cursor = tables(folder).execute(sql)
    names = [item[0] for item in cursor.description]
    sql_side = normal_rows(names, cursor.fetchall())
    return spark_side, sql_side
