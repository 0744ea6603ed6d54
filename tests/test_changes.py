import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from docweave.operators import changes as cdc
from docweave.operators.jobs import explode_jobs, last_jobs, next_jobs, parse_jobs, queue_depth
from docweave.operators.rules import Rule, apply_rules, effective_rules, require_rules, rule_match
from docweave.operators.strategy import strategy

CHANGE = "file string, pos long, action string, k string, v int"


def test_images_are_paired_by_row_number(frame):
    rows = frame([(1, 0, "a"), (1, 1, "b"), (1, 2, "c"), (1, 3, "d"), (2, 0, "e"), (2, 1, "f"), (2, 2, "g")], "event int, i int, v string")
    pairs = cdc.pair_images(rows, ["event"], "i", ["v"])
    found = rows_of(pairs.select("event", "pair_no", "old.v", F.col("new.v").alias("n")))
    assert found == [(1, 0, "a", "b"), (1, 1, "c", "d"), (2, 0, "e", "f")]


@pytest.mark.parametrize(
    "parts, key", [([("1", None)], "1"), ([(None, "2")], "2"), ([("1", None), ("b", None)], "[1+b]"), ([("1", None), (None, None)], "[1]"), ([(None, None), ("b", None)], "[+b]")]
)
def test_change_key(one, parts, key):
    columns = [(F.lit(new).cast("string"), F.lit(old).cast("string")) for new, old in parts]
    assert one(cdc.change_key(columns)) == key


def test_tag_and_its_reject_reason(one):
    def tag(db, tbl, action):
        return one(cdc.change_tag(F.lit(db), F.lit(tbl), F.lit(action), F.lit("9")))

    assert tag("db_App_media", "FM_Click_x", "update") == "app_click:9"
    assert tag("db_App_media", "FM_Click", "delete") == "app_click_delete:9"
    assert tag("db_app", "fm_x", "update") is None
    assert one(cdc.tag_reject(F.lit("db_app"), F.lit("fm_x"))) == "database segments"
    assert one(cdc.tag_reject(F.lit("a_b_c"), F.lit("x"))) == "table segments"


def test_state_keeps_the_last_change_and_deletes_the_base_key(frame):
    rows = frame(
        [("l1", 1, "insert", "a", 1), ("l1", 2, "update", "a", 2), ("l1", 3, "insert", "b", 3), ("l2", 1, "delete", "b", 3), ("l2", 2, "update", "c", None)], CHANGE
    )
    assert rows_of(cdc.kv_state(rows, F.col("k"), ["k", "v"])) == [("a", '{"k":"a","v":2}'), ("c", '{"k":"c"}')]
    assert rows_of(cdc.hash_state(rows, F.lit("m"), F.col("k"), ["v"])) == [("m", "a", '{"v":2}'), ("m", "c", "{}")]


def test_scored_set_takes_the_last_score(frame):
    rows = frame([("l1", 1, "insert", "a", 5), ("l1", 2, "update", "a", None), ("l1", 1, "insert", "b", 7)], CHANGE)
    scored = cdc.scored_set(rows, F.col("k"), F.col("v"), F.lit(100))
    assert rows_of(scored) == [("a", 100.0), ("b", 7.0)]


def test_batches_are_consecutive_and_bounded(spark):
    rows = spark.range(25).select(
        F.lit("l").alias("file"), F.col("id").alias("pos"), F.lit("update").alias("action"), (F.col("id") % 2).cast("string").alias("key"), F.col("id").alias("at")
    )
    batched = cdc.flush_batches(rows.repartition(4), 10)
    compacted = cdc.compact_ids(batched, F.lit("q"), F.concat(F.lit("t"), "key"), F.col("key"), F.col("at"))
    assert compacted.agg(F.max("n_ids")).first()[0] == 5 and compacted.agg(F.sum("n_ids")).first()[0] == 25
    assert ("q", "t1", "1,1,1,1,1") in {(r["queue"], r["tag"], r["ids"]) for r in compacted.collect()}
    once = cdc.compact_ids(batched, F.lit("q"), F.lit("t"), F.col("key"), F.col("at"), distinct=True)
    assert {r["ids"] for r in once.collect()} == {"0,1"}


def test_equal_members_keep_the_last_score(frame):
    rows = frame([(0, "q", "t", "1", 1, 10), (1, "q", "t", "1", 1, 5)], "batch_no long, queue string, tag string, ids string, n_ids long, score long")
    assert rows_of(cdc.compact_jobs(rows)) == [("q", "t:1", 5.0)]


def test_replay_is_strict(frame):
    rows = frame([("l1", 9, "u", "a", 1), ("l2", 1, "u", "a", 1), ("l2", 2, "u", "a", 1)], CHANGE)
    assert cdc.replay_from(rows, "l2", 1).count() == 1
    assert tuple(cdc.last_position(rows).first()) == ("l2", 2)


def test_bootstrap_overlays_the_dump(frame):
    dump = frame([("a", 1), ("b", 2)], "k string, v int")
    tail = frame([("l", 1, "delete", "a", 1), ("l", 1, "insert", "c", 3)], CHANGE)
    assert rows_of(cdc.bootstrap_and_tail(dump, tail, ["k"])) == [("b", 2), ("c", 3)]


@pytest.mark.parametrize(
    "job, reason",
    [
        ("app_media:1,2", None), ("app_media_delete:1@2", None), ("app_media", "format"), ("a:b:c", "format"), ("app_media:1@2@3", "retry format"),
        ("app_media:1@x", "retry number"), ("app_media:", "ids"), ("app_media:1,", "ids"), ("app_media:a", "ids"), ("app:1", "action"),
        ("app_media_update:1", "operation"), ("app_media_delete_now:1", None), ("app_media:" + "1" * 5000 + "x", "ids"),
    ],
)
def test_job_reject_reasons(frame, job, reason):
    row = parse_jobs(frame([(job,)], "member string")).first()
    assert row["reject_reason"] == reason
    assert (row["app"] is None) == (reason is not None)


def test_job_apps_and_expansion(frame):
    jobs = frame([("app_media:1,,2@3",), ("other_media:5",), ("bad",)], "member string")
    parsed = parse_jobs(jobs, apps=["app"])
    assert [r["reject_reason"] for r in parsed.collect()] == [None, "action", "format"]
    assert rows_of(explode_jobs(parsed)) == [("app", "media", "", 3, 1), ("app", "media", "", 3, 2)]


def test_queue_order_and_depth(frame):
    queue = frame([("b", 1.0), ("a", 1.0), ("c", 0.0), ("d", 9.0)], "member string, score double")
    assert [r["member"] for r in next_jobs(queue, 3).collect()] == ["c", "a", "b"]
    assert [r["member"] for r in last_jobs(queue, 2, offset=1).collect()] == ["b", "a"]
    assert rows_of(queue_depth(frame([("q",), ("q",), ("r",)], "queue string"), "queue", 2)) == [("q", 2, 1), ("r", 1, 0)]


CATALOG = [("db_a", "fm_x", True), ("db_a", "FM_Y", True), ("db_b", "fm_x", False), ("other", "fm_z", True)]


def test_rule_names_and_patterns(frame):
    catalog = frame(CATALOG, "db string, tbl string, has_key boolean")
    rules = [Rule(["db_a"], ["fm_y"], structure="string"), Rule(["db_.*"], ["x$"], structure="string"), Rule(["*"], ["*"], structure="string")]
    assert rows_of(rule_match(catalog, rules).select("tbl", "rule_id")) == [
        ("FM_Y", 0), ("FM_Y", 2), ("fm_x", 1), ("fm_x", 1), ("fm_x", 2), ("fm_x", 2), ("fm_z", 2)
    ]


def test_exclusion_and_missing_keys(frame):
    catalog = frame(CATALOG, "db string, tbl string, has_key boolean")
    rules = [Rule(["*"], ["*"], exclude_databases=["other"], exclude_tables=["fm_z"], structure="string"), Rule(["db_a"], ["fm_x"], structure="string")]
    found = effective_rules(catalog, rules).select("db", "tbl", "rule_id")
    assert rows_of(found) == [("db_a", "FM_Y", 0), ("db_a", "fm_x", 1)]
    with pytest.raises(Exception, match="primary key"):
        effective_rules(catalog, rules, skip_no_key=False).select("has_key").collect()
    with pytest.raises(ValueError):
        require_rules(found.filter("false"))


def test_rules_are_checked():
    for bad in (dict(databases=[""], tables=["t"]), dict(databases=["d"], tables=["t"], structure="tree"), dict(databases=["d"], tables=["t"], structure="hash")):
        with pytest.raises(ValueError):
            Rule(**bad)
    first, second = Rule(["a"], ["b"], structure="string"), Rule(["c"], ["d"], structure="string")
    assert first.databases != second.databases and first.exclude_tables is not second.exclude_tables


def test_width_mismatch_is_dropped(frame):
    rows = frame([("DB_a", "T", ["1", "2"]), ("db_a", "t", ["1"]), ("db_b", "t", ["1", "2"])], "db string, tbl string, row array<string>")
    assert apply_rules(rows, {"db_a:t": 2}).count() == 1


def test_unknown_strategy_fails():
    assert strategy("SEGMENTED") is strategy()
    with pytest.raises(ValueError):
        strategy("unheard")


def test_replay_position_reaches_the_files(spark, tmp_path):
    spark.createDataFrame([("log.1", 5, "a"), ("log.2", 7, "b")], "file string, pos long, action string").write.parquet(str(tmp_path / "feed"))
    feed = spark.read.parquet(str(tmp_path / "feed"))
    replayed = cdc.replay_from(feed, "log.1", 5)
    plan = replayed._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThan(file,log.1)" in pushed and "GreaterThan(pos,5)" in pushed
    assert rows_of(replayed.select("pos")) == [(7,)]
