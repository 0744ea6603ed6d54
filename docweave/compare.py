"""Compare a query result with its SQL twin, row by row and without order."""

from __future__ import annotations

import glob
import os
from collections import Counter
from datetime import datetime

from pyspark.sql import DataFrame


def open_duckdb(sf_dir: str):
    """A DuckDB connection with one view per table."""
    import duckdb

    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _cell(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _rows(rows, order) -> Counter:
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(result: DataFrame, connection, sql: str) -> str:
    """Empty text where both agree, else what differs."""
    answer = connection.execute(sql)
    names = [d[0] for d in answer.description]
    expected_rows = answer.fetchall()
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(result.columns)} != {sorted(names)}"
    actual = _rows(result.collect(), [result.columns.index(n) for n in sorted(names)])
    expected = _rows(expected_rows, [names.index(n) for n in sorted(names)])
    if actual == expected:
        return ""
    extra, missing = actual - expected, expected - actual
    return (
        f"{sum(actual.values())} rows, expected {sum(expected.values())}; columns {sorted(names)}\n"
        f"  only in result: {list(extra.items())[:3]}\n  only in SQL: {list(missing.items())[:3]}"
    )
