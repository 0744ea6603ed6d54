"""Word dictionary for the text analyser."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def dictionary_union(sources: list[tuple[DataFrame, str, str, str]]) -> DataFrame:
    """(``word``, ``update_time``, ``source``) of several entities; the first writer of a word wins.

    Each source is (rows, word column, update-time column, key column). First means source order,
    then key. The minimum is combined map-side, so a common word costs little.
    """
    combined = None
    for order, (df, word, updated, key) in enumerate(sources):
        part = df.select(
            F.col(word).alias("word"),
            F.lit(order).alias("source"),
            F.col(key).cast("long").alias("_key"),
            F.col(updated).cast("long").alias("update_time"),
        ).filter(F.col("word").isNotNull() & (F.col("word") != ""))
        combined = part if combined is None else combined.unionByName(part)
    first = F.min(F.struct("source", "_key", "update_time")).alias("_first")
    return combined.groupBy("word").agg(first).select("word", "_first.update_time", "_first.source")


def incremental_dictionary(dictionary: DataFrame, now: int, period: int) -> DataFrame:
    """Words changed after ``now - period``."""
    return dictionary.filter(F.col("update_time") > now - period)


def merge_dictionary(existing: DataFrame, found: DataFrame) -> DataFrame:
    """An existing dictionary and newly found words; a word that is there keeps its row, whoever finds it again."""
    fresh = found.join(existing.select("word"), "word", "left_anti")
    return existing.unionByName(fresh, allowMissingColumns=True)


def remove_words(existing: DataFrame, words: DataFrame) -> DataFrame:
    """The dictionary without the listed words."""
    return existing.join(words.select("word").distinct(), "word", "left_anti")


def export_dictionary(dictionary: DataFrame, path: str) -> bool:
    """One word per line with CRLF ends, in a new version folder that readers see once it is complete.

    The old export stays until then, and for readers that hold it. An empty dictionary leaves it in place.
    """
    spark = dictionary.sparkSession
    version = max(_versions(spark, path), default=-1) + 1
    folder = f"{path}/words-{version}"
    dictionary.select("word").write.mode("overwrite").option("lineSep", "\r\n").text(folder)
    if spark.read.text(folder).isEmpty():
        return False
    target, fs = _file_system(spark, f"{path}/current/{version}")
    fs.create(target, True).close()
    return True


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Words of the newest complete export."""
    version = max(_versions(spark, path))
    return spark.read.option("lineSep", "\r\n").text(f"{path}/words-{version}").select(F.col("value").alias("word"))


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, path: str) -> list[int]:
    target, fs = _file_system(spark, f"{path}/current")
    return [int(s.getPath().getName()) for s in fs.listStatus(target)] if fs.exists(target) else []
