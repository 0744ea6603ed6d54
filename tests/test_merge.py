import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from docweave.operators import merge, publish
from docweave.operators.dictionary import dictionary_union, export_dictionary, incremental_dictionary, read_dictionary
from docweave.operators.retry import retry_ledger

DOC = "id int, a int, b string, disable int"


def test_upsert_tells_absent_from_null_and_is_idempotent(frame):
    target = frame([(1, 10, "x", 0), (2, 20, "y", 0)], DOC)
    update = frame([(2, None), (3, 30)], "id int, a int")
    once = merge.upsert_merge(target, update, "id")
    assert rows_of(once) == [(1, 10, "x", 0), (2, None, "y", 0), (3, 30, None, None)]
    assert rows_of(merge.upsert_merge(once, update, "id")) == rows_of(once)


def test_upsert_adds_new_columns(frame):
    merged = merge.upsert_merge(frame([(1, 10)], "id int, a int"), frame([(1, "n")], "id int, c string"), "id")
    assert merged.columns == ["id", "a", "c"] and rows_of(merged) == [(1, 10, "n")]


def test_routes_cover_the_input(frame):
    rows = frame([(1, 1, "x", 0), (2, 2, "y", 1), (3, 3, "z", None)], DOC)
    upserts, deletes = merge.route_disabled(rows, False, "id")
    assert rows_of(upserts.select("id")) == [(1,), (3,)] and rows_of(deletes) == [(2,)]
    upserts, deletes = merge.route_disabled(rows, True, "id")
    assert upserts.count() == 3 and deletes.count() == 0


def test_batch_deletes_and_upserts(frame):
    target = frame([(1, 10, "x", 0), (2, 20, "y", 0), (3, 30, "z", 1)], DOC)
    batch = frame([(2, 0, 1), (1, 11, 0), (9, 9, 1)], "id int, a int, disable int")
    assert rows_of(merge.apply_batch(target, batch, "id")) == [(1, 11, "x", 0), (3, 30, "z", 1)]
    full = merge.apply_batch(target, batch, "id", is_full=True)
    assert rows_of(full.select("id")) == [(1,), (2,), (3,), (9,)]


def test_updates_by_id_map_and_expression(frame):
    target = frame([(1, 10, "x", 0), (2, 20, "y", 0)], DOC)
    ids = frame([(1,), (1,)], "id int")
    assert rows_of(merge.update_by_ids(target, ids, "id", "b", F.lit("n"))) == [(1, 10, "n", 0), (2, 20, "y", 0)]
    values = frame([(2, None)], "id int, b string")
    assert rows_of(merge.update_by_map(target, values, "id")) == [(1, 10, "x", 0), (2, 20, None, 0)]
    swapped = merge.update_expr(target, F.col("a") > 10, {"a": F.col("a") + 1, "b": F.col("a").cast("string")})
    assert rows_of(swapped) == [(1, 10, "x", 0), (2, 21, "20", 0)]
    brands = merge.dispatch_brands(frame([(1, 1), (2, 0)], "id int, enable int"), "id", "enable", "7")
    assert rows_of(brands) == [(1, ["7"]), (2, [])]


def test_outcomes_and_set_differences(frame):
    outcomes = frame([("a", 1, True), ("a", 2, False), ("a", 1, False), ("b", 3, False)], "action string, id int, failed boolean")
    assert rows_of(merge.bulk_outcome_summary(outcomes, "action", "failed")) == [("a", 2, 1), ("b", 1, 0)]
    assert rows_of(merge.succeeded_ids(outcomes, outcomes.filter("failed"), ["action", "id"])) == [("a", 2), ("b", 3)]
    assert rows_of(merge.without(outcomes.select("id"), frame([(1,), (1,)], "id int"), "id")) == [(2,), (3,)]


LEDGER = "tag string, id string, times int, expires_at long"


def test_retries_match_a_counter_kept_by_hand(frame):
    """Batches of outcomes against a plain counter with the same rules."""
    ledger, counter = frame([], LEDGER), {}
    batches = [
        (1000, [("a", True), ("b", True), ("c", False)]),
        (1100, [("a", True), ("b", False)]),
        (1200, [("a", True), ("d", True)]),
        (1300, [("a", True)]),
        (1400, [("a", True)]),
        (9000, [("d", True), ("a", True)]),
    ]
    for now, outcomes in batches:
        result = retry_ledger(frame([("t", i, f) for i, f in outcomes], "tag string, id string, failed boolean"), ledger, now)
        counter = {k: v for k, v in counter.items() if v[1] > now}
        requeued, gone = [], []
        for key, failed in outcomes:
            tried = counter.pop(key, (0, 0))[0]
            if failed and tried < 3:
                counter[key] = (tried + 1, now + 3600)
                requeued.append((f"t:{key}@{tried + 1}", 0.0))
            elif failed:
                gone.append(("t", key, tried))
        assert rows_of(result.requeue) == sorted(requeued)
        assert rows_of(result.exhausted) == gone
        ledger = frame([tuple(r) for r in result.ledger.collect()], LEDGER)
        assert rows_of(ledger) == sorted(("t", k, n, at) for k, (n, at) in counter.items())


def test_publish_switches_the_alias_and_retires(spark, frame, tmp_path):
    root = str(tmp_path)
    for n in range(1, 5):
        publish.publish_snapshot(frame([(n,)], "v int"), root, "app_media", f"2024010100000{n}")
        assert rows_of(publish.resolve_alias(spark, root, "app_media")) == [(n,)]
    gone = publish.retire_snapshots(spark, root, "app_media")
    assert [g[-14:] for g in gone] == ["20240101000001", "20240101000002"]
    assert publish.retire_snapshots(spark, root, "app_media") == []
    assert rows_of(publish.resolve_alias(spark, root, "app_media")) == [(4,)]
    assert sorted(p.name for p in (tmp_path / "app_media").iterdir()) == ["20240101000003", "20240101000004"]


def test_retention_spares_the_newest_other_version(frame):
    versions = frame(
        [("a", "3", True), ("a", "1", True), ("a", "5", False), ("a", "4", False), ("b", "1", True), ("c", "1", False)],
        "alias string, stamp string, pointed boolean",
    )
    found = rows_of(publish.retention_rank(versions).select("alias", "stamp", "verdict"))
    assert found == [("a", "1", "delete"), ("a", "3", "current"), ("a", "4", "delete"), ("a", "5", "spare"), ("b", "1", "current"), ("c", "1", "unknown")]


def test_first_writer_wins_and_empty_export_keeps_the_file(spark, frame, tmp_path):
    first = frame([(2, "x", 20), (1, "x", 10), (3, "", 1), (4, None, 1)], "k int, w string, at long")
    second = frame([(1, "x", 99), (2, "y", 30)], "k int, w string, at long")
    words = dictionary_union([(first, "w", "at", "k"), (second, "w", "at", "k")])
    assert rows_of(words) == [("x", 10, 0), ("y", 30, 1)]
    assert rows_of(incremental_dictionary(words, 40, 20).select("word")) == [("y",)]
    path = str(tmp_path / "dict")
    assert export_dictionary(words, path)
    assert not export_dictionary(words.filter("false"), path)
    assert rows_of(read_dictionary(spark, path)) == [("x",), ("y",)]
    content = b"".join(p.read_bytes() for p in sorted((tmp_path / "dict").glob("words-0/part-*")))
    assert content.count(b"\r\n") == 2


def test_app_view_fills_missing_columns(frame):
    view = merge.app_view({"a": frame([(1, 2)], "id int, x int"), "b": frame([(3, "q")], "id int, y string")})
    assert rows_of(view.select("entity", "id", "x", "y")) == [("a", 1, 2, None), ("b", 3, None, "q")]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_batch_does_not_shuffle_the_target(spark, tmp_path):
    spark.range(1000).select(F.col("id"), (F.col("id") * 2).alias("v")).write.parquet(str(tmp_path / "target"))
    target = spark.read.parquet(str(tmp_path / "target"))
    spark.createDataFrame([(5, -1), (2000, -2)], "id long, v long").write.parquet(str(tmp_path / "batch"))
    batch = spark.read.parquet(str(tmp_path / "batch"))
    merged = merge.upsert_merge(target, batch, "id")
    assert "hashpartitioning" not in _plan(merged) and "BroadcastHashJoin" in _plan(merged)
    rows = {r["id"]: r["v"] for r in merged.collect()}
    assert len(rows) == 1001 and rows[5] == -1 and rows[2000] == -2 and rows[6] == 12


def test_merge_adds_and_keeps_columns_of_both_sides(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id long, name string, n int")
    batch = spark.createDataFrame([(2, None, True), (3, "c", None)], "id long, name string, extra boolean")
    merged = merge.upsert_merge(target, batch, "id")
    assert merged.columns == ["id", "name", "n", "extra"]
    assert sorted(tuple(r) for r in merged.collect()) == [(1, "a", 1, None), (2, None, 2, True), (3, "c", None, None)]


def test_a_stamp_is_published_once(frame, tmp_path):
    root = str(tmp_path)
    publish.publish_snapshot(frame([(1,)], "v int"), root, "app_media", "20240101000000")
    with pytest.raises(ValueError):
        publish.publish_snapshot(frame([(2,)], "v int"), root, "app_media", "20240101000000")
    publish.publish_snapshot(frame([(3,)], "v int"), root, "app_actor", "20240101000000")


def test_export_keeps_the_old_words_until_the_new_are_complete(spark, frame, tmp_path, monkeypatch):
    path = str(tmp_path / "words")
    assert export_dictionary(frame([("a",), ("b",)], "word string"), path)
    held = read_dictionary(spark, path)
    broken = frame([("c",)], "word string").select(F.when(F.col("word") == "c", F.raise_error(F.lit("lost")).cast("string")).alias("word"))
    with pytest.raises(Exception, match="lost"):
        export_dictionary(broken, path)
    assert rows_of(read_dictionary(spark, path)) == [("a",), ("b",)]
    assert export_dictionary(frame([("d",)], "word string"), path)
    assert rows_of(read_dictionary(spark, path)) == [("d",)]
    assert rows_of(held) == [("a",), ("b",)]
    assert not export_dictionary(frame([], "word string"), path)
    assert rows_of(read_dictionary(spark, path)) == [("d",)]
