"""Streams against the batch operators, over several files and restarts."""

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from docweave.operators import changes as cdc
from docweave.operators.logs import log_upsert, parse_access_log
from docweave.operators.merge import apply_batch
from docweave.operators.retry import retry_ledger
from docweave.plans.fixtures import Tables, changes_of, log_lines_of
from docweave.session import fresh_dir
from docweave.sources.tables import read_change_feed, read_log_text
from docweave.streaming import feeds
from docweave.streaming.store import BatchStore, run_of

SF = "/root/testdata/sf0.001"


@pytest.fixture
def events(spark):
    return Tables(spark, SF).table("events")


def state_rows(rows):
    return changes_of(rows).select("key", "file", "pos", "action", "value")


def feed_of(spark, events, path, files=6):
    events.repartition(files, "event_id").write.mode("append").parquet(path)
    return read_change_feed(spark, path, events.schema, streaming=True, max_files=1)


def test_state_equals_batch_after_a_stop_and_a_replay(spark, events, tmp_path):
    stream = state_rows(feed_of(spark, events, f"{tmp_path}/feed"))
    target = feeds.state_target(spark, f"{tmp_path}/out", stream.schema, ["key"], shards=5)

    class Stop(Exception):
        pass

    def failing(batch, batch_id, run):
        target.apply(batch, lambda rows, new: cdc.latest_per_key(rows.unionByName(new), ["key"]))
        if batch_id == 2:
            raise Stop("after the write, before the commit")

    query = feeds.run_batches(stream, failing, f"{tmp_path}/checkpoint")
    with pytest.raises(Exception, match="after the write"):
        query.awaitTermination()
    feeds.stream_state(stream, target, f"{tmp_path}/checkpoint").awaitTermination()
    expected = rows_of(cdc.latest_per_key(state_rows(events), ["key"]).filter("action <> 'delete'"))
    assert rows_of(feeds.read_state(target)) == expected
    # a new checkpoint reads the feed again, and nothing changes but what is new
    more = events.limit(5).withColumns({"event_id": F.col("event_id") + 10_000_000, "event_type": F.lit("view")}).coalesce(1)
    feed_of(spark, more, f"{tmp_path}/feed", files=1)
    again = feeds.state_target(spark, f"{tmp_path}/out", stream.schema, ["key"], shards=5)
    feeds.stream_state(stream, again, f"{tmp_path}/other-checkpoint").awaitTermination()
    expected = rows_of(cdc.latest_per_key(state_rows(events.unionByName(more)), ["key"]).filter("action <> 'delete'"))
    assert rows_of(feeds.read_state(target)) == expected


def test_jobs_hold_every_change_once(spark, events, tmp_path):
    stream = changes_of(feed_of(spark, events, f"{tmp_path}/feed", files=3)).select("file", "pos", "db", "tbl", "action", "key", "event_time")
    store = BatchStore(spark, f"{tmp_path}/out", feeds.JOB_SCHEMA)
    feeds.stream_jobs(stream, store, F.lit("q"), F.lit("t"), f"{tmp_path}/checkpoint", bulk_size=50).awaitTermination()
    jobs = store.read()
    assert jobs.agg(F.sum("n_ids"), F.max("n_ids")).first()[:] == (events.count(), 50)
    ids = jobs.select(F.explode(F.split("ids", ",")).alias("key"))
    assert rows_of(ids.groupBy("key").count()) == rows_of(changes_of(events).groupBy("key").count())


def test_logs_equal_batch_with_repeated_lines(spark, events, tmp_path):
    lines = log_lines_of(events)
    for part in range(2):
        lines.select(F.col("line").alias("value")).repartition(2).write.mode("append").text(f"{tmp_path}/feed")
    stream = read_log_text(spark, f"{tmp_path}/feed", streaming=True, max_files=1)
    store = feeds.log_store(spark, f"{tmp_path}/out")
    feeds.stream_logs(stream, store, f"{tmp_path}/checkpoint").awaitTermination()
    assert rows_of(feeds.read_logs(store)) == rows_of(log_upsert(parse_access_log(lines)))


def outcomes_of(rows):
    return rows.select(
        F.lit("t").alias("tag"), F.col("user_id").cast("string").alias("id"), (F.col("value") > 30).alias("failed"), F.unix_timestamp("ts").alias("event_time")
    )


def test_retry_stream_equals_batch_folds(spark, events, tmp_path):
    days = [events.filter(F.dayofmonth("ts") % 3 == d).coalesce(1) for d in range(3)]
    store = feeds.RetryStore(spark, f"{tmp_path}/out")
    ledger = spark.createDataFrame([], feeds.LEDGER_SCHEMA)
    for number, day in enumerate(days):
        day.write.mode("append").parquet(f"{tmp_path}/feed")
        stream = outcomes_of(read_change_feed(spark, f"{tmp_path}/feed", events.schema, streaming=True))
        feeds.stream_retry(stream, store, f"{tmp_path}/checkpoint", ttl=10**7).awaitTermination()
        now = outcomes_of(day).agg(F.max("event_time")).first()[0]
        result = retry_ledger(outcomes_of(day), ledger, now, ttl=10**7)
        assert rows_of(store.requeue.batch(number)) == rows_of(result.requeue)
        assert rows_of(store.exhausted.batch(number)) == rows_of(result.exhausted)
        ledger = spark.createDataFrame(result.ledger.collect(), feeds.LEDGER_SCHEMA)
        run = run_of(spark, f"{tmp_path}/checkpoint")
        assert rows_of(store.ledger_before(number + 1, run)) == rows_of(ledger)
        assert rows_of(store.ledger_before(0, "a new checkpoint")) == rows_of(ledger)
    assert store.ledger.stored().select("_run", "_batch").distinct().count() == 2


def test_refresh_lays_updates_over_the_snapshot(spark, tmp_path):
    doc = Tables(spark, SF).doc.select("id", "disable", "update_time", "price")
    updates = doc.filter("id % 3 = 0").select("id", (F.col("id") % 2).cast("int").alias("disable"), (F.col("update_time") + 9).alias("update_time"))
    later = updates.filter("id % 9 = 0").select("id", F.lit(0).alias("disable"), (F.col("update_time") + 9).alias("update_time"))
    store = BatchStore(spark, f"{tmp_path}/out", updates.schema)
    for part in (updates, later):
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/feed")
        stream = read_change_feed(spark, f"{tmp_path}/feed", updates.schema, streaming=True)
        feeds.stream_refresh(stream, store, "id", "update_time", f"{tmp_path}/checkpoint").awaitTermination()
    newest = updates.join(later, "id", "left_anti").unionByName(later)
    assert rows_of(feeds.refreshed(doc, store, "id", "update_time")) == rows_of(apply_batch(doc, newest, "id"))


def test_empty_store_reads_empty(spark):
    assert BatchStore(spark, fresh_dir(spark, "none"), feeds.MEMBER_SCHEMA).read().count() == 0


def test_batches_of_different_runs_stay_apart(spark, tmp_path):
    """A checkpoint that was reset starts at batch 0 again: its rows are added, and a repeated batch replaces itself."""
    store = BatchStore(spark, str(tmp_path), spark.range(1).schema)
    store.write(spark.range(0, 2), 0, "one")
    store.write(spark.range(2, 4), 0, "two")
    store.write(spark.range(4, 9), 1, "two")
    store.write(spark.range(4, 6), 1, "two")
    assert sorted(r["id"] for r in store.read().collect()) == list(range(6))
    assert sorted(r["id"] for r in store.batch(0).collect()) == [0, 1, 2, 3]
    assert [r["id"] for r in store.batch(0, "one").orderBy("id").collect()] == [0, 1]


def test_a_reset_checkpoint_loses_no_input(spark, events, tmp_path):
    lines = log_lines_of(events).select(F.col("line").alias("value"))
    store = feeds.log_store(spark, f"{tmp_path}/out")
    for part in range(2):
        half = lines.filter(F.pmod(F.xxhash64("value"), F.lit(2)) == part)
        half.coalesce(1).write.text(f"{tmp_path}/feed-{part}")
        stream = read_log_text(spark, f"{tmp_path}/feed-{part}", streaming=True)
        feeds.stream_logs(stream, store, f"{tmp_path}/checkpoint-{part}").awaitTermination()
    assert rows_of(feeds.read_logs(store)) == rows_of(log_upsert(parse_access_log(lines.select(F.col("value").alias("line")))))


def test_a_run_is_the_same_after_a_restart(spark, tmp_path):
    schema = "key string, action string, value int, file string, pos long"
    seen = []
    for i in range(3):
        rows = [(str(k), "update", i, "f", i * 10 + k) for k in range(3)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "feed"))
        feed = spark.readStream.schema(schema).parquet(str(tmp_path / "feed"))
        feeds.run_batches(feed, lambda batch, n, run: seen.append((n, run)), str(tmp_path / "checkpoint")).awaitTermination()
    assert [n for n, _ in seen] == [0, 1, 2] and len({run for _, run in seen}) == 1


def test_writer_of_jobs_waits_for_a_slow_consumer(spark, events, tmp_path):
    """The consumer takes one job at every look at the queue; the queue exceeds its limit by a batch at most."""
    stream = changes_of(feed_of(spark, events, f"{tmp_path}/feed", files=6)).select("file", "pos", "db", "tbl", "action", "key", "event_time")
    store = BatchStore(spark, f"{tmp_path}/out", feeds.JOB_SCHEMA)
    taken, depths, limit = [0], [], 3
    members = feeds.depth_of(lambda: store.read().select("queue"), "q")

    def depth():
        depths.append(members() - taken[0])
        taken[0] += depths[-1] > 0
        return depths[-1]

    feeds.stream_jobs(stream, store, F.lit("q"), F.lit("t"), f"{tmp_path}/checkpoint", bulk_size=10, depth=depth, limit=limit, pause=0).awaitTermination()
    per_batch = store.stored().groupBy("_batch").count().agg(F.max("count")).first()[0]
    assert max(depths) < limit + per_batch and sum(d >= limit for d in depths) > 5
    assert store.read().agg(F.sum("n_ids")).first()[0] == events.count()


def test_depth_of_an_empty_queue(spark):
    members = spark.createDataFrame([("a",)], "queue string")
    assert feeds.depth_of(lambda: members, "a")() == 1 and feeds.depth_of(lambda: members, "b")() == 0
    seen = iter([5, 4, 1])
    assert feeds.wait_for_room(lambda: next(seen), 2, sleep=lambda s: None) == 2
