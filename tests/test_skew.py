"""Whole and exact results where one key has a third of the rows, against brute force."""

from collections import Counter, defaultdict

from conftest import rows_of
from pyspark.sql import functions as F

from docweave.operators import enrich
from docweave.operators.asof import position_as_of
from docweave.operators.numbering import assign_versions, global_index, index_sort, rank_in_group
from docweave.operators.postings import prefix_index, prefix_postings, weighted_postings
from docweave.operators.skew import hot_keys, salted_join

N = 3000


def skewed(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 101 + 100)
    return spark.range(0, N, 1, 8).select(F.col("id"), key.cast("long").alias("k"), (F.col("id") * 7919 % 1000).alias("v"))


def test_positions_are_gap_free_with_a_hot_value(spark):
    numbered = global_index(skewed(spark), "k", "v", "id", name="no").collect()
    expected = sorted((r["k"], r["v"], r["id"]) for r in numbered)
    assert [(r["k"], r["v"], r["id"]) for r in sorted(numbered, key=lambda r: r["no"])] == expected
    assert sorted(r["no"] for r in numbered) == list(range(1, N + 1))


def test_a_hot_value_spans_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranged = skewed(spark).repartitionByRange("k", "v", "id").withColumn("p", F.spark_partition_id())
        assert ranged.filter("k = 7").select("p").distinct().count() > 1
        order = [F.col("v").desc(), F.col("id")]
        ranked = rank_in_group(skewed(spark), ["k"], order, name="r", rows_per_task=100).collect()
        assert rows_of(rank_in_group(skewed(spark), ["k"], order, name="r")) == sorted(map(tuple, ranked), key=repr)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    groups = defaultdict(list)
    for row in ranked:
        groups[row["k"]].append(row)
    for rows in groups.values():
        ordered = sorted(rows, key=lambda r: (-r["v"], r["id"]))
        assert [r["r"] for r in ordered] == list(range(1, len(rows) + 1))


def test_versions_start_where_asked(spark):
    versions = assign_versions(spark.range(50), "id", start=1000)
    assert sorted(tuple(r) for r in versions.collect()) == [(i, 1000 + i) for i in range(50)]


def test_stored_order(spark, tmp_path):
    rows = skewed(spark).select(F.col("id"), F.col("v").alias("update_time"), (N - F.col("id")).alias("version_id"))
    for full, order in ((False, lambda r: (-r[1], r[0])), (True, lambda r: r[2])):
        path = str(tmp_path / str(full))
        index_sort(rows, "id", full).write.parquet(path)
        stored = []
        for part in sorted((tmp_path / str(full)).glob("part-*")):
            stored += [tuple(r) for r in spark.read.parquet(str(part)).collect()]
        assert stored == sorted(stored, key=order) and len(stored) == N


def test_salted_join_equals_the_plain_one(spark):
    left, right = skewed(spark), spark.range(90, 150).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    right = right.unionByName(spark.createDataFrame([(7, "hot")], right.schema))
    assert rows_of(hot_keys(left, ["k"], 300)) == [(7, 4)]
    for how in ("left", "inner"):
        salted = salted_join(left, right, ["k"], how, rows_per_task=300)
        assert rows_of(salted.select("id", "k", "name")) == rows_of(left.join(right, "k", how).select("id", "k", "name"))


def test_salts_follow_the_size_of_a_key_and_split_equal_rows(spark):
    key = F.when(F.col("id") < 6000, 1).when(F.col("id") < 8000, 2).otherwise(F.col("id"))
    rows = spark.range(10_000).select(key.cast("long").alias("k"))
    assert rows_of(hot_keys(rows, ["k"], 1000)) == [(1, 6), (2, 2)]
    right = spark.createDataFrame([(1, "a"), (2, "b")], "k long, n string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = salted_join(rows, right, ["k"], rows_per_task=1000).withColumn("p", F.spark_partition_id())
        assert joined.filter("k = 1").select("p").distinct().count() > 1  # all rows of the key are equal
        assert joined.filter("n = 'a'").count() == 6000 and joined.count() == 10_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_salted_join_keeps_null_keys(spark, frame):
    left, right = frame([(1, None), (2, 5)], "id int, k int"), frame([(5, "x")], "k int, n string")
    assert rows_of(salted_join(left, right, ["k"]).select("id", "n")) == [(1, None), (2, "x")]


def test_same_name_sources_by_brute_force(spark):
    rows = skewed(spark).select("id", "k", F.concat(F.lit("s"), F.col("v") % 4).alias("source"))
    plain = [tuple(r) for r in rows.collect()]
    groups = defaultdict(list)
    for key, group, source in plain:
        groups[group].append((key, source))
    counts = {g: Counter(s for _, s in members) for g, members in groups.items()}
    expected = []
    for key, group, source in plain:
        left = counts[group] - Counter([source])
        expected.append((key, sorted(left)))
    for salted in (False, True):
        found = enrich.same_name_sources(rows, key="id", group=["k"], source="source", salted=salted)
        assert rows_of(found.select("id", "exclude_source")) == sorted(expected, key=repr)


def test_bridge_pairs_count_once_and_documents_without_match_stay(spark, frame):
    bridge = skewed(spark).select(F.col("k").alias("doc"), (F.col("v") % 5).alias("tag"))
    dim = frame([(i, f"t{i}", 10 - i) for i in range(4)], "tag long, name string, std long")
    enriched = enrich.bridge_enrich(
        bridge, dim, key="doc", dim_key="tag", name_col="name", ids_as="ids", names_as="names", standard_col="std", standard_as="stds"
    )
    documents = frame([(7,), (1,)], "doc long")
    found = rows_of(enrich.attach(documents, enriched, "doc"))
    assert found == [(1, [], [], []), (7, [0, 1, 2, 3], ["t0", "t1", "t2", "t3"], [7, 8, 9, 10])]


def test_people_order_and_ties(frame):
    bridge = frame([(1, 1, 5), (1, 2, 5), (1, 3, 5), (1, 4, 9), (1, 4, 1)], "doc int, p int, priority int")
    people = frame([(1, "a", 1), (2, "b", 1), (3, "c", 2), (4, "d", 0)], "p int, name string, apriority int")
    found = enrich.people_enrich(bridge, people, key="doc", dim_key="p", name_col="name", ids_as="ids", names_as="names").first()
    assert (found["ids"], found["names"]) == ([4, 3, 2, 1], ["d", "c", "b", "a"])


def test_available_count_counts_documents_once(frame):
    bridge = frame([(1, 1), (1, 1), (2, 1), (3, 1), (3, 2)], "doc int, p int")
    documents = frame([(1, 0), (2, 1), (3, 0)], "doc int, disable int")
    found = enrich.available_count(bridge, documents, key="doc", person="p", enabled=F.col("disable") == 0, count_as="n")
    assert rows_of(found) == [(1, 2), (2, 1)]


def test_position_as_of_by_brute_force(spark):
    log = spark.range(0, 400, 1, 4).select(
        F.concat(F.lit("l"), F.floor(F.col("id") / 100)).alias("file"),
        (F.col("id") % 100).alias("pos"),
        # a third of the log in one second, the rest over days and out of order
        F.when(F.col("id") % 3 == 0, 500_000).otherwise(F.col("id") * 7919 % 700_000).alias("at"),
    )
    points = spark.range(0, 900_000, 9_000).select(F.col("id").alias("q")).unionByName(spark.createDataFrame([(500_000,)] * 50, "q long"))
    rows = [tuple(r) for r in log.collect()]
    expected = []
    for (asked,) in (tuple(r) for r in points.collect()):
        seen = [(f, p) for f, p, at in rows if 1000 <= at <= asked]
        expected.append((asked, *(max(seen) if seen else (None, None))))
    found = position_as_of(log, points, log_ts="at", point_ts="q", start=1000)
    assert rows_of(found) == sorted(expected, key=repr)


def test_prefixes_by_brute_force(frame):
    texts = {1: "Blue-Gear the then", 2: "Été 'the' " + "x" * 25, 3: "", 4: None}
    rows = frame(list(texts.items()), "id int, text string")
    import re

    expected = set()
    for key, text in texts.items():
        for word in re.findall(r"[^\W_]+", (text or "").lower()):
            expected |= {(key, word[:n]) for n in range(1, min(len(word), 20) + 1)}
    assert rows_of(prefix_postings(rows, "id", "text")) == sorted(expected, key=repr)
    counts = Counter(term for _, term in expected)
    assert {r["term"]: r["n_docs"] for r in prefix_index(rows, "id", "text").collect()} == counts
    weighted = weighted_postings(frame([(1, "ab", "a")], "id int, x string, y string"), "id", {"x": 20, "y": 5})
    assert rows_of(weighted) == [("a", 1, 25), ("ab", 1, 20)]


def test_adaptive_execution_splits_a_hot_lookup_key(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        keys = spark.range(0, 60_000, 1, 8).select(F.col("id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
        dim = spark.range(0, 60_000, 1, 4).select(F.col("id").alias("k"), (F.col("id") * 2).alias("n"))
        joined = enrich.lookup(keys, dim, "k")
        assert {r["n"] == r["k"] * 2 for r in joined.collect()} == {True}
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_alias_is_limited_before_the_shuffle(spark):
    from docweave.operators.publish import retention_rank

    versions = spark.range(0, N, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("a"), F.col("id") % 50)).alias("alias"),
        F.lpad(F.col("id").cast("string"), 14, "0").alias("stamp"),
        (F.col("id") % 7 < 3).alias("pointed"),
    )
    ranked = retention_rank(versions)
    assert "WindowGroupLimit" in ranked._jdf.queryExecution().executedPlan().toString()
    groups = defaultdict(list)
    for row in ranked.collect():
        groups[row["alias"]].append(row)
    assert sum(len(g) for g in groups.values()) == N
    for rows in groups.values():
        current = max((r["stamp"] for r in rows if r["pointed"]), default=None)
        spare = max((r["stamp"] for r in rows if r["stamp"] != current), default=None)
        for r in rows:
            expected = "unknown" if current is None else "current" if r["stamp"] == current else "spare" if r["stamp"] == spare else "delete"
            assert r["verdict"] == expected


def test_empty_inputs(spark, frame):
    empty = frame([], "id long, k long, v long")
    assert global_index(empty, "k", "id").count() == 0
    assert rank_in_group(empty, ["k"], [F.col("id")]).count() == 0
    log = frame([], "file string, pos long, at long")
    points = frame([(5,)], "q long")
    assert rows_of(position_as_of(log, points, log_ts="at", point_ts="q")) == [(5, None, None)]
    assert prefix_index(frame([], "id int, t string"), "id", "t").count() == 0
