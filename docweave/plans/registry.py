"""Named queries and, where plain SQL can say the same, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from docweave.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}

_INTEGRAL = {"tinyint", "smallint", "int", "boolean"}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} exists")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(configure(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            TWINS[name] = sql
        return fn

    return add


def plain(df: DataFrame) -> DataFrame:
    """Result columns in forms every SQL engine prints alike: long numbers, arrays as joined text."""
    columns = []
    for name, dtype in df.dtypes:
        if dtype in _INTEGRAL:
            columns.append(F.col(name).cast("bigint").alias(name))
        elif dtype.startswith("array"):
            columns.append(F.array_join(F.col(name).cast("array<string>"), ",").alias(name))
        else:
            columns.append(F.col(name))
    return df.select(*columns)


def with_views(*views: str, select: str) -> str:
    """A SELECT over named common table expressions."""
    return f"WITH {', '.join(views)} {select}"
