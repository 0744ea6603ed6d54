import pytest
from conftest import rows_of

from docweave.operators.changes import replay_from
from docweave.sources.position import ChangeLogReader, PositionStore, follow_changes

SCHEMA = "file string, pos long, key string, value double"


@pytest.fixture
def log(spark, tmp_path):
    """``log(rows)`` appends one Parquet file."""

    def add(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/log")
        return f"{tmp_path}/log"

    return add


def some(file, low, high):
    return [(file, p, f"k{p % 7}", float(p)) for p in range(low, high)]


def drain(spark, path, checkpoint, out, schema, **options):
    stream = follow_changes(spark, path, schema, **options)
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


def test_starts_behind_any_position_without_a_checkpoint(spark, log, tmp_path):
    for rows in (some("l1", 0, 50), some("l1", 50, 90) + some("l2", 0, 20), some("l2", 20, 60)):
        path = log(rows)
    every = spark.read.parquet(path)
    for n, at in enumerate([None, ("l1", 10), ("l1", 89), ("l2", 19), ("l2", 59), ("l1", 1000)]):
        got = drain(spark, path, f"{tmp_path}/cp{n}", f"{tmp_path}/out{n}", every.schema, after=at)
        expected = every if at is None else replay_from(every, *at)
        assert rows_of(got) == rows_of(expected), at


def test_goes_on_at_its_checkpoint_and_by_a_saved_position(spark, log, tmp_path):
    path = log(some("l1", 0, 30))
    schema = spark.read.parquet(path).schema
    drain(spark, path, f"{tmp_path}/cp", f"{tmp_path}/out", schema)
    saved = PositionStore(spark, f"{tmp_path}/position")
    assert saved.load() is None
    assert saved.save_last(spark.read.parquet(path)) == ("l1", 29)
    log(some("l1", 30, 40) + some("l2", 0, 5))
    assert rows_of(drain(spark, path, f"{tmp_path}/cp", f"{tmp_path}/out", schema)) == rows_of(spark.read.parquet(path))
    # another reader takes the saved position, with no checkpoint of the first
    got = drain(spark, path, f"{tmp_path}/cp2", f"{tmp_path}/out2", schema, after=saved.load())
    assert rows_of(got) == rows_of(replay_from(spark.read.parquet(path), "l1", 29))
    # a position that is set back by hand counts from then on
    saved.save(("l1", 3))
    assert saved.load() == ("l1", 3)
    assert saved.save_last(spark.read.parquet(path).limit(0)) is None


def test_limits_stop_at_file_ends(spark, log):
    for n in range(5):
        path = log(some("l1", n * 10, n * 10 + 10))
    reader, at, ends = ChangeLogReader({"path": path, "max_changes": "25"}, spark.read.parquet(path).schema), {"file": "", "pos": -1}, []
    for _ in range(4):
        end = reader.latestOffset()
        reader.partitions(at, end)
        at = end
        ends.append(end["pos"])
    assert ends == [19, 39, 49, 49]


def test_files_outside_of_a_batch_are_not_opened(spark, log):
    for n in range(4):
        path = log(some(f"l{n}", 0, 10))
    reader = ChangeLogReader({"path": path}, spark.read.parquet(path).schema)
    parts = reader.partitions({"file": "l1", "pos": 9}, {"file": "l2", "pos": 4})
    assert len(parts) == 1
    rows = [r for b in reader.read(parts[0]) for r in b.to_pylist()]
    assert [(r["file"], r["pos"]) for r in rows] == [("l2", p) for p in range(5)]


def test_missing_columns_are_null_and_empty_logs_read_empty(spark, log, tmp_path):
    path = log(some("l1", 0, 3))
    schema = spark.createDataFrame([], "pos long, extra string, key string").schema
    got = drain(spark, path, f"{tmp_path}/cp", f"{tmp_path}/out", schema)
    assert rows_of(got.select("pos", "extra")) == [(0, None), (1, None), (2, None)]
    reader = ChangeLogReader({"path": f"{tmp_path}/none"}, schema)
    assert reader.latestOffset() == reader.initialOffset() == {"file": "", "pos": -1}
    assert reader.partitions(reader.initialOffset(), reader.latestOffset()) == []
