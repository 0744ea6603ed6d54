"""Relational tables, change feeds and log text as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from docweave.sources.tail import tail_lines


def read_table(spark: SparkSession, source: str | dict[str, str], predicates: list[str] | None = None) -> DataFrame:
    """A table by Parquet path, or over JDBC from an options dict.

    ``predicates`` (for example from ``page_predicates``) makes one parallel JDBC read per range.
    """
    if isinstance(source, str):
        return spark.read.parquet(source)
    options = dict(source)
    if predicates:
        url, table = options.pop("url"), options.pop("dbtable")
        return spark.read.jdbc(url, table, predicates=predicates, properties=options)
    return spark.read.format("jdbc").options(**options).load()


def page_predicates(key: str, starts: list[int]) -> list[str]:
    """Half-open key ranges for a partitioned JDBC read, from the start keys of the pages."""
    ordered = sorted(set(starts))
    if not ordered:
        return []
    ranges = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(ordered, ordered[1:])]
    return ranges + [f"{key} >= {ordered[-1]}"]


def read_change_feed(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    streaming: bool = False,
    max_files: int | None = None,
) -> DataFrame:
    """Row changes from Parquet files, as a batch or as a stream that follows new files."""
    if not streaming:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    if schema is None:
        raise ValueError("a streaming change feed needs its schema")
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def read_log_text(
    spark: SparkSession, path: str, streaming: bool = False, max_files: int | None = None, follow: bool = False, max_bytes: int | None = None
) -> DataFrame:
    """Log lines in column ``line``.

    The plain stream picks up files as they appear and reads each once; with ``follow`` it also reads what files gain later, over
    rotation and truncation (see ``tail``), ``max_bytes`` at a time.
    """
    if follow:
        return tail_lines(spark, path, max_bytes).select("line")
    if not streaming:
        lines = spark.read.text(path)
    else:
        reader = spark.readStream
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        lines = reader.text(path)
    return lines.select(F.col("value").alias("line"))


def epoch_seconds(ts: Column) -> Column:
    """Epoch seconds of a timestamp with or without zone (the session zone is UTC)."""
    return F.unix_timestamp(ts.cast("timestamp"))
