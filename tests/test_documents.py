from dataclasses import replace

import pytest

from docweave.plans.consume import Route, consume_jobs
from docweave.plans.document_queries import media_inputs
from docweave.plans.fixtures import Tables
from docweave.plans.media import build_media_document

SF = "/root/testdata/sf0.001"


def test_children_are_read_for_the_changed_documents_only(spark):
    t = Tables(spark, SF)
    changed = t.media.filter("id % 50 = 1")
    part = build_media_document(replace(media_inputs(t), base=changed, all_documents=t.media), start_version=None)
    plan = part._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") >= 7  # five bridges, the episodes and the names
    full = build_media_document(media_inputs(t)).drop("version_id").filter("id % 50 = 1")
    columns = sorted(full.columns)
    assert sorted(map(repr, part.select(columns).collect())) == sorted(map(repr, full.select(columns).collect()))


def test_consumed_jobs_leave_the_queue_and_failures_come_back(spark):
    queue = spark.createDataFrame(
        [("a_x:1,2", 1.0), ("a_x_delete:3", 2.0), ("a_x:3,9", 3.0), ("a_x_delete:2", 4.0), ("bad", 0.0), ("a_x:7", 9.0)],
        "member string, score double",
    )
    source = spark.createDataFrame([(1, "new"), (2, "new"), (3, "new"), (4, "new")], "id long, v string")
    target = spark.createDataFrame([(2, "old"), (3, "old"), (5, "old")], "id long, v string")
    ledger = spark.createDataFrame([], "tag string, id bigint, times int, expires_at bigint")
    failed = spark.createDataFrame([("a_x", 1)], "tag string, id long")
    done = consume_jobs(queue, 5, [Route(["a_x"], source, target)], ledger=ledger, now=100, failed=failed)
    # 1 failed, 2 was deleted last, 3 was upserted after its delete, 9 has no row
    assert sorted(tuple(r) for r in done.targets[0].collect()) == [(3, "new"), (5, "old")]
    assert sorted(tuple(r) for r in done.queue.collect()) == [("a_x:1@1", 0.0), ("a_x:7", 9.0)]
    assert [r["member"] for r in done.rejected.collect()] == ["bad"]
    assert [(r["id"], r["times"]) for r in done.ledger.select("id", "times").collect()] == [(1, 1)]
    assert done.exhausted.count() == 0


def test_a_small_batch_does_not_shuffle_its_target(spark):
    """The source is too large to broadcast by its estimate; what the jobs select of it is small."""
    rows = spark.range(3_000_000).selectExpr("id", "cast(id as string) AS v")
    queue = spark.createDataFrame([("a_x:1,2", 1.0)], "member string, score double")
    ledger = spark.createDataFrame([], "tag string, id bigint, times int, expires_at bigint")
    done = consume_jobs(queue, 5, [Route(["a_x"], rows, rows)], ledger=ledger, now=100)
    plan = done.targets[0]._jdf.queryExecution().executedPlan().toString()
    merges = [line for line in plan.splitlines() if "LeftOuter" in line]
    assert merges and all("BroadcastHashJoin" in line for line in merges)


def test_jobs_of_entities_that_share_ids_stay_apart(spark):
    queue = spark.createDataFrame(
        [("app_media:1,2", 1.0), ("app_actor_delete:1", 2.0), ("app_actor:3", 3.0), ("app_album:1", 4.0), ("app_film_delete:2", 5.0)], "member string, score double"
    )
    media = spark.createDataFrame([(1, "m1"), (2, "m2")], "id long, v string")
    actors = spark.createDataFrame([(1, "a1"), (3, "a3")], "id long, v string")
    shelf = spark.createDataFrame([("app_film", 2, "f"), ("app_song", 2, "s")], "tag string, id long, v string")
    ledger = spark.createDataFrame([], "tag string, id bigint, times int, expires_at bigint")
    routes = [
        Route(["app_media"], media, media.limit(0)),
        Route(["app_actor"], actors, actors.filter("id = 1"), build=lambda rows: rows.selectExpr("id", "upper(v) AS v")),
        Route(["app_film", "app_song"], shelf, shelf, tag="tag"),
    ]
    done = consume_jobs(queue, 9, routes, ledger=ledger, now=0)
    found = [sorted(tuple(r) for r in t.collect()) for t in done.targets]
    assert found == [[(1, "m1"), (2, "m2")], [(3, "A3")], [("app_song", 2, "s")]]
    assert [tuple(r) for r in done.rejected.collect()] == [("app_album:1", "entity")]
    with pytest.raises(ValueError):
        Route(["a_x", "a_y"], media, media)
