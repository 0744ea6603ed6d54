"""Queries that run streams to the end of their input and return what they wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from docweave.operators import changes as cdc
from docweave.operators.strategy import strategy
from docweave.plans.change_queries import V_BATCH, V_COMPACT, V_LAST
from docweave.plans.fixtures import Tables, V_CHANGE, V_LOG, V_LOG_LINE, changes_of, log_lines_of
from docweave.plans.log_queries import DOCUMENT_SQL, printable
from docweave.plans.registry import query, with_views
from docweave.session import fresh_dir
from docweave.sources.position import PositionStore, follow_changes
from docweave.sources.tables import read_change_feed, read_log_text
from docweave.streaming.feeds import JOB_SCHEMA, log_store, read_logs, read_state, state_target, stream_jobs, stream_logs, stream_state
from docweave.streaming.store import BatchStore

STATE_KEYS = ["base", "key"]
STATE_SHARDS = 8
_STATE_COLUMNS = ["base", "key", "file", "pos", "action", "value"]
_STATE_SQL = with_views(V_CHANGE, V_LAST, select=f"SELECT {', '.join(_STATE_COLUMNS)} FROM v_last WHERE action <> 'delete'")


def _events(spark: SparkSession, path: str, like: DataFrame, max_files: int | None = None) -> DataFrame:
    return read_change_feed(spark, path, like.schema, streaming=True, max_files=max_files)


def _state_rows(changes: DataFrame) -> DataFrame:
    return changes.withColumn("base", cdc.tag_base(F.col("db"), F.col("tbl"))).select(*_STATE_COLUMNS)


@query("l1_stream_state", _STATE_SQL)
def _(spark: SparkSession, sf: str) -> DataFrame:
    root = fresh_dir(spark, "state")
    events = _events(spark, f"{sf}/event*.parquet", Tables(spark, sf).table("events"))
    rows = _state_rows(changes_of(events))
    target = state_target(spark, f"{root}/out", rows.schema, STATE_KEYS, STATE_SHARDS)
    stream_state(rows, target, f"{root}/checkpoint").awaitTermination()
    return read_state(target)


@query("l2_stream_jobs", with_views(V_CHANGE, V_BATCH, V_COMPACT, select="SELECT * FROM v_compact"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    root = fresh_dir(spark, "jobs")
    changes = changes_of(_events(spark, f"{sf}/event*.parquet", Tables(spark, sf).table("events")))
    rows = changes.select("file", "pos", "db", "tbl", "action", "key", "event_time")
    store = BatchStore(spark, f"{root}/out", JOB_SCHEMA)
    queue_tag = strategy().queue_tag(F.col("db"), F.col("tbl"), F.col("action"))
    stream_jobs(rows, store, F.lit("jobs"), queue_tag, f"{root}/checkpoint").awaitTermination()
    return store.read().drop("run")


@query("l3_stream_logs", with_views(V_LOG_LINE, V_LOG, select=f"SELECT DISTINCT {DOCUMENT_SQL} FROM v_log WHERE reason IS NULL"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    root = fresh_dir(spark, "logs")
    lines = log_lines_of(_events(spark, f"{sf}/event*.parquet", Tables(spark, sf).table("events")))
    store = log_store(spark, f"{root}/out")
    stream_logs(lines, store, f"{root}/checkpoint").awaitTermination()
    return printable(read_logs(store))


@query("l3_stream_tail", with_views(V_LOG_LINE, V_LOG, select=f"SELECT DISTINCT {DOCUMENT_SQL} FROM v_log WHERE reason IS NULL"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The log grows by a file between two runs of the tail; the second goes on where the first ended."""
    root = fresh_dir(spark, "tail")
    t = Tables(spark, sf)
    store = log_store(spark, f"{root}/out")
    for part in range(2):
        late = F.pmod(F.xxhash64("line"), F.lit(2)) == part
        t.log_line.filter(late).select(F.col("line").alias("value")).write.mode("append").text(f"{root}/log")
        stream_logs(read_log_text(spark, f"{root}/log", follow=True), store, f"{root}/checkpoint").awaitTermination()
    return printable(read_logs(store))


@query("l4_stream_resume", _STATE_SQL)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The feed arrives in three parts; each run goes on where the one before it ended."""
    root = fresh_dir(spark, "resume")
    events = Tables(spark, sf).table("events")
    target = state_target(spark, f"{root}/out", _state_rows(changes_of(events)).schema, STATE_KEYS, STATE_SHARDS)
    for part in range(3):
        events.filter(F.col("event_id") % 3 == part).write.mode("append").parquet(f"{root}/feed")
        rows = _state_rows(changes_of(_events(spark, f"{root}/feed", events, max_files=4)))
        stream_state(rows, target, f"{root}/checkpoint").awaitTermination()
    return read_state(target)


@query("l4_stream_from_position", _STATE_SQL)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """A bootstrap takes the changes up to a saved position; a stream without its checkpoint follows from there, while the log grows."""
    root = fresh_dir(spark, "position")
    changes = _state_rows(changes_of(Tables(spark, sf).table("events")))
    saved = PositionStore(spark, f"{root}/position")
    bounds = changes.agg(F.min("pos").alias("a"), F.max("pos").alias("b")).first()
    width = (bounds["b"] - bounds["a"]) // 3 + 1
    target = state_target(spark, f"{root}/out", changes.schema, STATE_KEYS, STATE_SHARDS)
    for part in range(3):
        low = bounds["a"] + part * width
        mine = changes.filter(F.col("pos").between(low, low + width - 1))
        # a writer appends behind what is there, in the order of the log
        mine.withColumn("file", F.lit("log")).repartitionByRange(2, "pos").sortWithinPartitions("pos").write.mode("append").parquet(f"{root}/log")
        if part == 0:
            first = spark.read.schema(changes.schema).parquet(f"{root}/log")
            target.create(cdc.latest_per_key(first, STATE_KEYS))
            saved.save_last(first)
        else:
            feed = follow_changes(spark, f"{root}/log", changes.schema, after=saved.load())
            stream_state(feed, target, f"{root}/checkpoint-{part}").awaitTermination()
            saved.save_last(target.read())
    named = changes.select("pos", F.col("file").alias("_file"))
    return read_state(target).drop("file").join(named, "pos").withColumnRenamed("_file", "file").select(*_STATE_COLUMNS)
