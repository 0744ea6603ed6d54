import os

import pytest
from conftest import rows_of

from docweave.operators import merge
from docweave.operators.shards import ShardedTarget

SCHEMA = "id long, disable int, name string"


@pytest.fixture
def target(spark, tmp_path):
    rows = spark.createDataFrame([(i, 0, f"n{i}") for i in range(200)] + [(None, 0, "no key")], SCHEMA)
    return ShardedTarget(spark, str(tmp_path / "docs"), rows.schema, ["id"], shards=16).create(rows)


def files(target):
    return {d: sorted(os.listdir(f"{target.path}/{d}")) for d in os.listdir(target.path) if d.startswith("_shard=")}


def batch_merge(rows, batch):
    return merge.apply_batch(rows, batch, "id")


def test_other_shards_keep_their_files(spark, target):
    before = files(target)
    assert len(before) == 16 and all(len([f for f in names if f.endswith(".parquet")]) == 1 for names in before.values())
    batch = spark.createDataFrame([(3, 0, "new"), (7, 1, None), (1000, 0, "added")], SCHEMA)
    touched = target.apply(batch, batch_merge)
    after = files(target)
    assert 1 <= len(touched) <= 3
    assert {d for d in before if before[d] != after[d]} == {f"_shard={n}" for n in touched}
    expected = merge.apply_batch(spark.createDataFrame([(i, 0, f"n{i}") for i in range(200)], SCHEMA), batch, "id")
    assert rows_of(target.read()) == rows_of(expected)


def test_repeated_batch_changes_nothing(spark, target):
    batch = spark.createDataFrame([(5, 0, "x"), (6, 1, "y")], SCHEMA)
    target.apply(batch, batch_merge)
    once = rows_of(target.read())
    target.apply(batch, batch_merge)
    assert rows_of(target.read()) == once


def test_a_shard_may_lose_all_rows(spark, target):
    everything = target.read().selectExpr("id", "1 AS disable", "name")
    assert target.apply(spark.createDataFrame(everything.collect(), SCHEMA), batch_merge) == list(range(16))
    assert target.read().count() == 0
    target.apply(spark.createDataFrame([(1, 0, "back"), (None, 0, "no key")], SCHEMA), batch_merge)
    assert rows_of(target.read()) == [(1, 0, "back")]


def test_empty_batch_and_several_keys(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "tag string, id long, v string")
    target = ShardedTarget(spark, str(tmp_path / "t"), rows.schema, ["tag", "id"], shards=3).create(rows)
    assert target.apply(rows.limit(0), lambda old, new: old) == []
    target.apply(spark.createDataFrame([("a", 1, "z")], rows.schema), lambda old, new: merge.upsert_merge(old, new, ["tag", "id"]))
    assert rows_of(target.read()) == [("a", 1, "z"), ("b", 1, "y")]
    with pytest.raises(ValueError):
        ShardedTarget(spark, "x", spark.createDataFrame([], "_shard int").schema, ["_shard"])


def test_only_touched_shards_are_read(spark, target):
    plans = []

    def spy(rows, batch):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return merge.apply_batch(rows, batch, "id")

    target.apply(spark.createDataFrame([(3, 0, "new")], SCHEMA), spy)
    pruned = plans[0][plans[0].index("PartitionFilters: [") :]
    assert "_shard#" in pruned[: pruned.index("]")]
