"""Output of a stream as partitions of a Parquet folder, one for each run and micro-batch.

A *run* is the id Spark gives to a checkpoint. A micro-batch replaces the partition of its own run and number, so a
repeated one leaves what it left before, and a new checkpoint, whose numbers start again, adds to what is there.
Input that a new checkpoint reads again is stored again; readers resolve rows by key, as they do for a key that comes twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

RUN, BATCH = "_run", "_batch"


class BatchStore:
    """Rows of a fixed schema below ``root``."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType) -> None:
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    def write(self, batch: DataFrame, batch_id: int, run: str) -> None:
        """The rows of one micro-batch in place of those it wrote before."""
        rows = batch.select(*self.schema.fieldNames(), F.lit(run).alias(RUN), F.lit(batch_id).cast("long").alias(BATCH))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN, BATCH).parquet(self.root)

    def read(self) -> DataFrame:
        """All rows."""
        return self.stored().select(*self.schema.fieldNames())

    def batch(self, batch_id: int, run: str | None = None) -> DataFrame:
        """The rows of one micro-batch, of one run or all."""
        rows = self.stored().filter(F.col(BATCH) == batch_id)
        return (rows if run is None else rows.filter(F.col(RUN) == run)).select(*self.schema.fieldNames())

    def stored(self) -> DataFrame:
        """All rows with their run and batch."""
        schema = StructType([*self.schema.fields, StructField(RUN, StringType()), StructField(BATCH, LongType())])
        try:
            return self.spark.read.schema(schema).parquet(self.root)
        except AnalysisException as missing:  # nothing was written yet
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id of a checkpoint that a query has started with."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def run_batches(
    stream: DataFrame,
    handle: Callable[[DataFrame, int, str], None],
    checkpoint: str,
    interval: str | None = None,
):
    """Start a stream that hands every micro-batch, its number and its run to ``handle``.

    The checkpoint holds the source positions: a restart goes on behind the last finished batch and
    repeats an unfinished one. Without an interval the query ends when the present input is used up.
    """
    runs: list[str] = []

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if not runs:
            runs.append(run_of(batch.sparkSession, checkpoint))
        handle(batch, batch_id, runs[0])

    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()
