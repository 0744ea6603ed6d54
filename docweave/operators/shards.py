"""A keyed target in shards: a batch reads and rewrites only the shards it touches.

A target is a Parquet folder partitioned by ``shard``, the hash of a row's key. A batch's shards are found from the batch,
the target is read for those only (partition pruning), and the merged rows replace them by dynamic partition
overwrite: Spark stages the new files and moves a shard's folder when the job is committed, and files of other shards are not
touched. Applying a batch again gives the same target, so a repeated batch does no harm.

Each shard keeps one row without key, which readers leave out: so a shard whose documents are all gone is still
replaced. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructType

SHARD = "_shard"
SHARDS = 64


class ShardedTarget:
    """Rows of a schema, keyed by ``keys``, below ``path``; ``order`` is their order inside a shard's files."""

    def __init__(
        self, spark: SparkSession, path: str, schema: StructType, keys: list[str], shards: int = SHARDS, order: list[str | Column] | None = None
    ) -> None:
        if any(c.name == SHARD for c in schema.fields):
            raise ValueError(f"{SHARD} is the name of the shard column")
        self.spark, self.path, self.schema, self.keys, self.shards = spark, path, schema, keys, shards
        self.order = order or list(keys)

    def shard(self) -> Column:
        """Shard number of a row, from its key."""
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.shards)).cast("int")

    def create(self, rows: DataFrame) -> ShardedTarget:
        """Write all rows; rows without a full key are left out. Every shard is written, so that an empty target can be read."""
        self._write(rows, self.spark.range(self.shards).select(F.col("id").cast("int").alias(SHARD)))
        return self

    def read(self) -> DataFrame:
        """All rows."""
        return self._stored().select(*self.schema.fieldNames())

    def touched(self, batch: DataFrame) -> list[int]:
        """Shards of the keys of a batch; at most as many as there are shards."""
        return sorted(r[0] for r in batch.dropna(subset=self.keys).select(self.shard()).distinct().collect())

    def apply(self, batch: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        """Replace the touched shards by ``merge(their rows, batch)``, which must keep each key; returns the shards."""
        touched = self.touched(batch)
        if touched:
            rows = self._stored().filter(F.col(SHARD).isin(touched)).select(*self.schema.fieldNames())
            marks = self.spark.createDataFrame([(n,) for n in touched], f"{SHARD} int")
            self._write(merge(rows, batch.dropna(subset=self.keys)), marks)
        return touched

    def _stored(self) -> DataFrame:
        with_shard = StructType([*self.schema.fields]).add(SHARD, IntegerType())
        stored = self.spark.read.schema(with_shard).parquet(self.path)
        present = F.lit(True)
        for key in self.keys:
            present = present & F.col(key).isNotNull()
        return stored.filter(present)

    def _write(self, rows: DataFrame, marks: DataFrame) -> None:
        placed = rows.dropna(subset=self.keys).select(*self.schema.fieldNames(), self.shard().alias(SHARD))
        every = placed.unionByName(marks, allowMissingColumns=True)
        # the number of partitions is fixed, so a shard is one file, in order
        dealt = every.repartition(self.shards, SHARD).sortWithinPartitions(SHARD, *self.order)
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(SHARD).parquet(self.path)
