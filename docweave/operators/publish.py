"""Versioned snapshots behind an alias.

A snapshot is a Parquet folder; the catalogue is a small append-only table of (alias, stamp, path,
live). Readers resolve the alias through the catalogue, so a version becomes visible with one append
and no reader ever sees a gap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from docweave.operators.merge import apply_batch

CATALOG_SCHEMA = StructType(
    [
        StructField("alias", StringType()),
        StructField("stamp", StringType()),
        StructField("path", StringType()),
        StructField("status", StringType()),
        StructField("seq", LongType()),
    ]
)


def read_catalog(spark: SparkSession, root: str) -> DataFrame:
    """Latest status of every version."""
    entries = spark.read.schema(CATALOG_SCHEMA).parquet(f"{root}/_catalog")
    return entries.groupBy("alias", "stamp").agg(
        F.max_by("path", "seq").alias("path"), F.max_by("status", "seq").alias("status")
    )


def _has_catalog(spark: SparkSession, root: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_catalog")
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _versions(spark: SparkSession, root: str, alias: str) -> DataFrame:
    return read_catalog(spark, root).filter(F.col("alias") == alias)


def _append_catalog(spark: SparkSession, root: str, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, CATALOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/_catalog")


def publish_snapshot(df: DataFrame, root: str, alias: str, stamp: str) -> DataFrame:
    """Write a fresh version, then point the alias at it; returns the version as read back.

    A stamp that the alias has or had is refused: its readers would lose their files, and a retired one stays retired.
    """
    spark = df.sparkSession
    if _has_catalog(spark, root) and not _versions(spark, root, alias).filter(F.col("stamp") == stamp).isEmpty():
        raise ValueError(f"{alias} already has the stamp {stamp}")
    path = f"{root}/{alias}/{stamp}"
    df.write.mode("overwrite").parquet(path)
    _append_catalog(spark, root, [(alias, stamp, path, "live", int(stamp) * 2)])
    return spark.read.schema(df.schema).parquet(path)


def resolve_alias(spark: SparkSession, root: str, alias: str) -> DataFrame:
    """Rows of the newest live version."""
    newest = (
        read_catalog(spark, root)
        .filter((F.col("alias") == alias) & (F.col("status") == "live"))
        .orderBy(F.col("stamp").desc())
        .first()
    )
    if newest is None:
        raise ValueError(f"no live version of {alias}")
    return spark.read.parquet(newest["path"])


def publish_with_catch_up(
    df: DataFrame, changed: DataFrame, root: str, alias: str, stamps: tuple[str, str], key: str, is_full: bool = False
) -> DataFrame:
    """Publish a snapshot, then a version with the rows that changed during the load."""
    loaded = publish_snapshot(df, root, alias, stamps[0])
    return publish_snapshot(apply_batch(loaded, changed, key, is_full), root, alias, stamps[1])


def retention_rank(versions: DataFrame, alias: str = "alias", stamp: str = "stamp", pointed: str = "pointed") -> DataFrame:
    """Versions with ``verdict``: ``current``, ``spare``, ``delete``, or ``unknown`` without a current one.

    Current is the newest version the alias points at; of all others the newest is spared, which is
    one of the two newest. Stamps are unique per alias. The two newest are picked by a rank limit
    that already applies before the shuffle, so an alias may have any number of versions.
    """
    current = versions.groupBy(alias).agg(F.max(F.when(F.col(pointed), F.col(stamp))).alias("_current"))
    newest_first = Window.partitionBy(alias).orderBy(F.col(stamp).desc())
    newest = versions.select(alias, stamp).withColumn("_rank", F.row_number().over(newest_first)).filter("_rank <= 2")
    decided = (
        newest.join(current, alias)
        .groupBy(alias, "_current")
        .agg(F.max(F.when(~F.col(stamp).eqNullSafe(F.col("_current")), F.col(stamp))).alias("_spare"))
    )
    verdict = (
        F.when(F.col("_current").isNull(), "unknown")
        .when(F.col(stamp) == F.col("_current"), "current")
        .when(F.col(stamp) == F.col("_spare"), "spare")
        .otherwise("delete")
    )
    return versions.join(decided, alias).withColumn("verdict", verdict).drop("_current", "_spare")


def retire_snapshots(spark: SparkSession, root: str, alias: str) -> list[str]:
    """Drop all versions of an alias but the current and the newest other one.

    They leave the catalogue first; then their folders go. The list is as long as the alias has
    versions, not rows.
    """
    versions = read_catalog(spark, root).filter((F.col("alias") == alias) & (F.col("status") == "live"))
    newest = versions.agg(F.max("stamp")).first()[0]
    ranked = retention_rank(versions.withColumn("pointed", F.col("stamp") == newest))
    doomed = [(r["stamp"], r["path"]) for r in ranked.filter("verdict = 'delete'").select("stamp", "path").collect()]
    if doomed:
        _append_catalog(spark, root, [(alias, s, p, "retired", int(s) * 2 + 1) for s, p in doomed])
        for _, path in doomed:
            _remove(spark, path)
    return sorted(path for _, path in doomed)


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
