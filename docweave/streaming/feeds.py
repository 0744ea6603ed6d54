"""Streaming forms of the state, job, log, retry and refresh operators.

A state is a target in shards that each micro-batch is merged into. The other streams run the batch operator on their micro-batch and
write to a ``BatchStore``; readers resolve the batches with the same operator. Sources limit what a batch takes (``max_files``, ``max_bytes``, ``max_changes``); a writer of jobs
also waits while its queue is full.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from docweave.operators import changes as cdc
from docweave.operators.jobs import queue_depth
from docweave.operators.logs import LOG_SCHEMA, log_upsert, parse_access_log
from docweave.operators.merge import apply_batch
from docweave.operators.retry import MAX_RETRY, TTL_SECONDS, retry_ledger
from docweave.operators.shards import SHARDS, ShardedTarget
from docweave.streaming.store import BATCH, RUN, BatchStore, run_batches

JOB_SCHEMA = StructType(
    [
        StructField("run", LongType()),
        StructField("batch_no", LongType()),
        StructField("queue", StringType()),
        StructField("tag", StringType()),
        StructField("ids", StringType()),
        StructField("n_ids", LongType()),
        StructField("score", LongType()),
    ]
)
LEDGER_SCHEMA = StructType(
    [
        StructField("tag", StringType()),
        StructField("id", StringType()),
        StructField("times", IntegerType()),
        StructField("expires_at", LongType()),
    ]
)
MEMBER_SCHEMA = StructType([StructField("member", StringType()), StructField("score", DoubleType())])
EXHAUSTED_SCHEMA = StructType(LEDGER_SCHEMA.fields[:3])


def state_target(spark: SparkSession, root: str, schema: StructType, keys: list[str], shards: int = SHARDS) -> ShardedTarget:
    """An empty state for ``stream_state``, or the one that is there."""
    target = ShardedTarget(spark, root, schema, keys, shards)
    try:
        spark.read.parquet(root)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        target.create(spark.createDataFrame([], schema))
    return target


def stream_state(changes: DataFrame, target: ShardedTarget, checkpoint: str, interval: str | None = None):
    """Keep the last change per key: each micro-batch is reduced and laid over the shards it touches.

    The last change is the one with the highest position, so a batch that comes again, or feeds that are read anew, change nothing.
    Deletes stay as rows, so that nothing older comes back.
    """

    def newest(rows: DataFrame, batch: DataFrame) -> DataFrame:
        return cdc.latest_per_key(rows.unionByName(batch), target.keys)

    def handle(batch: DataFrame, batch_id: int, run: str) -> None:
        fixed = cdc.latest_per_key(batch.select(*target.schema.fieldNames()), target.keys).persist()
        target.apply(fixed, newest)
        fixed.unpersist()

    return run_batches(changes, handle, checkpoint, interval)


def read_state(target: ShardedTarget) -> DataFrame:
    """Current rows of a state, deletes left out."""
    return target.read().filter(F.col("action") != "delete")


def wait_for_room(depth: Callable[[], int], limit: int, pause: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> int:
    """Wait until a queue holds fewer than ``limit`` members; returns how often it was full."""
    waited = 0
    while depth() >= limit:
        waited += 1
        sleep(pause)
    return waited


def depth_of(members: Callable[[], DataFrame], queue: str) -> Callable[[], int]:
    """The measured depth of a queue: a function that counts its members (column ``queue``) anew at every call."""

    def depth() -> int:
        row = queue_depth(members().filter(F.col("queue") == queue), "queue", 1).first()
        return row["depth"] if row else 0

    return depth


def stream_jobs(
    changes: DataFrame,
    store: BatchStore,
    queue: Column,
    tag: Column,
    checkpoint: str,
    bulk_size: int = cdc.BULK_SIZE,
    interval: str | None = None,
    depth: Callable[[], int] | None = None,
    limit: int = 0,
    pause: float = 1.0,
):
    """Compact the changes of every micro-batch to jobs, at most ``bulk_size`` changes to a job.

    With a ``depth`` function a batch is written only when the queue holds fewer than ``limit`` jobs. Until then the stream takes no
    further input, so the queue never exceeds the limit by more than one batch, whose size the source limits.
    """

    def handle(batch: DataFrame, batch_id: int, run: str) -> None:
        if depth is not None:
            wait_for_room(depth, limit, pause)
        batched = cdc.flush_batches(batch, bulk_size)
        jobs = cdc.compact_ids(batched, queue, tag, F.col("key"), F.col("event_time"))
        store.write(jobs.withColumn("run", F.lit(batch_id).cast("long")), batch_id, run)

    return run_batches(changes, handle, checkpoint, interval)


def stream_logs(lines: DataFrame, store: BatchStore, checkpoint: str, slow_ms: float = 0.0, interval: str | None = None):
    """Parse log lines into documents.

    Equal lines of a micro-batch become one document. Lines that come again later, however late, are
    stored again and resolved by ``read_logs``; no watermark drops them.
    """

    def handle(batch: DataFrame, batch_id: int, run: str) -> None:
        store.write(log_upsert(parse_access_log(batch, slow_ms)), batch_id, run)

    return run_batches(lines, handle, checkpoint, interval)


def log_store(spark: SparkSession, root: str) -> BatchStore:
    """Store for ``stream_logs``."""
    return BatchStore(spark, root, LOG_SCHEMA)


def read_logs(store: BatchStore) -> DataFrame:
    """One document per id."""
    return log_upsert(store.read())


class RetryStore:
    """Ledger, requeued members and given-up ids.

    A ledger is complete after every batch. Two are kept for each run, by even and odd batch numbers, so that a repeated batch finds the one
    before it. A row without tag carries the clock of the ledger and says that it is there, even if it is empty.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        schema = StructType([*LEDGER_SCHEMA.fields, StructField("after", LongType())])
        self.ledger = BatchStore(spark, f"{root}/ledger", schema)
        self.requeue = BatchStore(spark, f"{root}/requeue", MEMBER_SCHEMA)
        self.exhausted = BatchStore(spark, f"{root}/exhausted", EXHAUSTED_SCHEMA)
        self.spark = spark

    def ledger_before(self, batch_id: int, run: str) -> DataFrame:
        """The ledger as the batch found it: that of the batch before, or the last of another run, the one with the latest clock."""
        stored = self.ledger.stored()
        marks = stored.filter("tag is null")
        mine = marks.filter((F.col(RUN) == run) & (F.col("after") == batch_id - 1))
        ended = marks.filter(F.col(RUN) != run).groupBy(RUN).agg(F.max(F.struct("after", "expires_at", BATCH)).alias("last"))
        before = mine.first() or ended.select(RUN, "last.*").orderBy(F.desc("expires_at"), RUN).first()
        if before is None:
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        rows = stored.filter((F.col(RUN) == before[RUN]) & (F.col(BATCH) == before[BATCH]) & F.col("tag").isNotNull())
        return rows.select(*LEDGER_SCHEMA.fieldNames())

    def write_ledger(self, ledger: DataFrame, batch_id: int, run: str, clock: int) -> None:
        """The ledger after a batch."""
        mark = self.spark.createDataFrame([(None, None, None, clock)], LEDGER_SCHEMA)
        rows = ledger.select(*[F.col(f.name).cast(f.dataType) for f in LEDGER_SCHEMA.fields]).union(mark)
        self.ledger.write(rows.withColumn("after", F.lit(batch_id).cast("long")), batch_id % 2, run)


def stream_retry(
    outcomes: DataFrame,
    store: RetryStore,
    checkpoint: str,
    max_retry: int = MAX_RETRY,
    ttl: int = TTL_SECONDS,
    interval: str | None = None,
):
    """Count retries over micro-batches of outcomes (``tag``, ``id``, ``failed``, ``event_time``).

    The clock is the latest event time of the batch, so a replay gives the same ledger.
    """

    def handle(batch: DataFrame, batch_id: int, run: str) -> None:
        now = batch.agg(F.max("event_time")).first()[0] or 0
        result = retry_ledger(batch, store.ledger_before(batch_id, run), now, max_retry, ttl)
        store.requeue.write(result.requeue, batch_id, run)
        store.exhausted.write(result.exhausted, batch_id, run)
        store.write_ledger(result.ledger, batch_id, run, now)

    return run_batches(outcomes, handle, checkpoint, interval)


def stream_refresh(updates: DataFrame, store: BatchStore, key: str, order: str, checkpoint: str, interval: str | None = None):
    """Collect changed documents; ``refreshed`` lays them over a snapshot."""

    def handle(batch: DataFrame, batch_id: int, run: str) -> None:
        store.write(newest_update(batch, key, order), batch_id, run)

    return run_batches(updates, handle, checkpoint, interval)


def newest_update(updates: DataFrame, key: str, order: str) -> DataFrame:
    """The last update per key by ``order``."""
    rest = [c for c in updates.columns if c != key]
    last = F.max_by(F.struct(*rest), F.col(order)).alias("_last")
    return updates.groupBy(key).agg(last).select(key, "_last.*")


def refreshed(snapshot: DataFrame, store: BatchStore, key: str, order: str, is_full: bool = False) -> DataFrame:
    """The snapshot with all collected updates applied."""
    return apply_batch(snapshot, newest_update(store.read(), key, order), key, is_full)

