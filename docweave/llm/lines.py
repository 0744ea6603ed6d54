"""Line de-duplication over levelled sorted runs of line hashes.

A *run* is a table of ``(h1, h2, n_docs, keep)``, one row per line key, bucketed and sorted by the hash:
in how many documents of its batches the key was found, and the largest ``doc_id`` among them. A new
batch is reduced to its own keys, merge-anti-joined with every run (keys that a run already decides are
not stored again) and added as a run of level 0. When a level holds ``fanout`` runs they are merged into
one run of the next level, so the number of runs grows with the logarithm of the number of batches.
Batches must not share document ids.

Everything is DataFrame code; only hashes travel until the last step, where each text is shuffled once.
"""

from __future__ import annotations

import string
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docweave.session import fresh_dir, materialize

BLANKS = " \t\n\u000b\f\r"
MIN_CHARS = 20
MIN_DOCS = 3
DROP_PARTS = 4096
BATCHES = 4
FANOUT = 3
_KEYS = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line without ASCII blanks at both ends and with A-Z in lower case."""
    trimmed = F.btrim(line, F.lit(BLANKS))
    ascii_only = F.octet_length(trimmed) == F.char_length(trimmed)
    folded = F.translate(trimmed, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(ascii_only, F.lower(trimmed)).otherwise(folded)


def text_lines(text: Column) -> Column:
    """All lines of a text; none or an empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hashes(key: Column) -> tuple[Column, Column]:
    """128 bits of a key: two hashes with different seeds."""
    return F.xxhash64(F.lit(1), key).alias("h1"), F.xxhash64(F.lit(2), key).alias("h2")


@dataclass(frozen=True)
class Run:
    """One stored run: ``bucketed`` for joins on the hash, ``plain`` for merges.

    A union of bucketed scans is read in columns, partition after partition, but planned as if equal buckets met;
    merges therefore read the files as plain Parquet and combine before a shuffle of their own.
    """

    bucketed: DataFrame
    plain: DataFrame


class LineRuns:
    """Levels of sorted runs in the shared folder of the session."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, min_docs: int = MIN_DOCS, buckets: int | None = None):
        self.spark, self.fanout, self.min_docs = spark, fanout, min_docs
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[Run]] = []

    def _store(self, run: DataFrame) -> Run:
        path = fresh_dir(self.spark, "line-run")
        name = path.rsplit("/", 1)[1].replace("-", "_")
        (
            run.repartition(self.buckets, *_KEYS)
            .sortWithinPartitions(*_KEYS)
            .write.bucketBy(self.buckets, *_KEYS)
            .sortBy(*_KEYS)
            .option("path", path)
            .saveAsTable(name)
        )
        return Run(self.spark.table(name), self.spark.read.schema(run.schema).parquet(path))

    def runs(self) -> list[Run]:
        """All runs, the newest level first."""
        return [run for level in self.levels for run in level]

    def add(self, keyed: DataFrame) -> None:
        """Add a batch of ``(doc_id, h1, h2)`` rows whose documents are in no earlier batch."""
        batch = keyed.groupBy(*_KEYS).agg(F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("keep"))
        for run in self.runs():
            decided = run.bucketed.filter(F.col("n_docs") >= self.min_docs).select(*_KEYS, F.col("keep").alias("_keep"))
            batch = batch.alias("b").join(
                decided.alias("r"),
                (F.col("b.h1") == F.col("r.h1")) & (F.col("b.h2") == F.col("r.h2")) & (F.col("r._keep") > F.col("b.keep")),
                "left_anti",
            )
        self._push(0, self._store(batch))

    def _push(self, level: int, run: Run) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = self._merge(self.levels[level])
            self.levels[level] = []
            self._push(level + 1, self._store(merged))

    @staticmethod
    def _merge(runs: list[Run]) -> DataFrame:
        """One row per key."""
        every = reduce(DataFrame.unionByName, [run.plain for run in runs])
        return every.groupBy(*_KEYS).agg(F.sum("n_docs").alias("n_docs"), F.max("keep").alias("keep"))

    def repeated(self) -> DataFrame:
        """``(h1, h2, keep)`` of the keys found in at least ``min_docs`` documents."""
        return self._merge(self.runs()).filter(F.col("n_docs") >= self.min_docs).select(*_KEYS, "keep")


def _part(h1: Column) -> Column:
    """Part of a document's dropped hashes that a hash belongs to."""
    return F.pmod(h1, F.lit(DROP_PARTS)).cast("int")


def dedup_lines(
    documents: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The documents with their repeated lines taken out of ``text``, plus ``_n_lines`` and ``_n_dropped``.

    A key of at least ``min_chars`` code points that is found in at least ``min_docs`` documents loses all
    its lines except in the largest document id that holds it. Batches are id ranges, the largest ids
    first, so that later batches meet decided keys. All other columns stay as they are. A row without an
    id, text, or lines long enough keeps all its lines (no text: null stays null, one empty line); rows
    that share an id are one document for the counts and are each returned. No rows in, no rows out.
    """
    spark = documents.sparkSession
    cuts = _cuts(documents, key, batches)
    lines = documents.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("doc_id"), F.explode(text_lines(F.col(text))).alias("line")
    )
    keyed = lines.select("doc_id", line_key(F.col("line")).alias("key")).filter(F.char_length("key") >= min_chars)
    below = [F.when(F.col("doc_id") < F.lit(cut), 1).otherwise(0) for cut in cuts]
    batch = reduce(Column.__add__, below, F.lit(0)).alias("batch")
    hashed = materialize(keyed.select("doc_id", *_hashes(F.col("key")), batch), "line-hashes")

    runs = LineRuns(spark, fanout, min_docs)
    for number in range(len(cuts) + 1):
        runs.add(hashed.filter(F.col("batch") == number).drop("batch"))
    repeated = materialize(runs.repeated(), "line-verdicts")  # a plain scan, so that a hot key can be split
    dropped = (
        hashed.join(repeated.hint("merge"), _KEYS)
        .filter(F.col("doc_id") != F.col("keep"))
        .groupBy(F.col("doc_id").alias("_drop_id"), _part(F.col("h1")).alias("part"))
        .agg(F.collect_set(F.struct("h1", "h2")).alias("hashes"))
        .groupBy("_drop_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("part", "hashes"))).alias("_drop"))
    )
    joined = documents.join(dropped, F.col(key) == F.col("_drop_id"), "left")
    every = text_lines(F.col(text))

    def with_hashes(line: Column) -> Column:
        return F.struct(line.alias("line"), F.struct(*_hashes(line_key(line))).alias("h"))

    def stays(one: Column) -> Column:
        # only the hashes of one part are looked through, so a text of very many lines is not quadratic
        return ~F.coalesce(F.array_contains(F.try_element_at(F.col("_drop"), _part(one["h"]["h1"])), one["h"]), F.lit(False))

    left = F.transform(F.filter(F.transform(every, with_hashes), stays), lambda one: one["line"])
    kept = F.when(F.col("_drop").isNull(), every).otherwise(left)
    # the short lines of a document can't be in _drop: its hashes come from long keys only
    return (
        joined.withColumn("_n_lines", F.size(every).cast("long"))
        .withColumn("_kept", kept)
        .withColumn("_n_dropped", F.col("_n_lines") - F.size("_kept"))
        .withColumn(text, F.when(F.col("_drop").isNull(), F.col(text)).otherwise(F.array_join("_kept", "\n")))
        .select(*documents.columns, "_n_lines", "_n_dropped")
    )


def _cuts(documents: DataFrame, key: str, batches: int) -> list:
    """At most ``batches - 1`` ids, largest first, that cut the ids into about equal ranges."""
    shares = [i / batches for i in range(1, batches)]
    if not shares:
        return []
    found = documents.agg(F.percentile_approx(F.col(key), shares).alias("cuts")).first()["cuts"]
    return sorted(set(found or []), reverse=True)


def line_dedup_digest(documents: DataFrame) -> DataFrame:
    """Per document: lines before, lines dropped and the hash of what is kept."""
    slim = documents.select("doc_id", "text")
    return dedup_lines(slim).select(
        "doc_id",
        F.col("_n_lines").alias("n_lines"),
        F.col("_n_dropped").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )
