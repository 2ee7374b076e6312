"""Comparison of a Spark result with DuckDB's result for the same tables."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def duckdb_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    connection = duckdb.connect()
    try:
        for path in glob.glob(f"{sf_dir}/*.parquet"):
            name = os.path.basename(path).removesuffix(".parquet")
            files = f"{path}/*.parquet" if os.path.isdir(path) else path
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{files}'")
        result = connection.execute(sql)
        return [column[0] for column in result.description], result.fetchall()
    finally:
        connection.close()


def _plain(value):
    if isinstance(value, datetime.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return value


def normalised(columns: list[str], rows) -> list[tuple]:
    """Rows with columns by name, in an order that does not depend on the engine."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)
