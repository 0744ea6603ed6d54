import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from docweave.sources import scans
from docweave.sources.tables import page_predicates, read_change_feed


def test_id_list_is_cleaned_and_checked():
    assert scans.parse_ids(" 1, 2，3,,4 ,") == [1, 2, 3, 4]
    for bad in ("", "1;2", "a", ",,"):
        with pytest.raises(ValueError):
            scans.parse_ids(bad)


def test_long_id_list_returns_all_ids(spark):
    rows = spark.range(5000).withColumnRenamed("id", "k")
    ids = ",".join(str(i) for i in range(0, 4000, 2))
    assert scans.id_list_scan(rows, "k", ids).count() == 2000


def test_time_range_needs_both_bounds_in_order(spark):
    assert scans.parse_time_range("", " ") is None
    assert scans.parse_time_range("2021-07-06 15:12:24", "2021-07-07 17:06:31") == (1625584344, 1625677591)
    for bad in (("2021-07-06 15:12:24", ""), ("2021-07-07 00:00:00", "2021-07-06 00:00:00"), ("x", "y")):
        with pytest.raises(ValueError):
            scans.parse_time_range(*bad)
    rows = spark.range(100).withColumnRenamed("id", "at")
    assert scans.time_range_scan(rows, "at", 10, 20).count() == 11


def test_incremental_bound_is_strict(spark):
    rows = spark.range(100).withColumnRenamed("id", "at")
    assert scans.incremental_scan(rows, "at", now=100, period=10).agg(F.min("at")).first()[0] == 91


def test_selection_precedence(spark):
    rows = spark.range(100).select(F.col("id").alias("k"), F.col("id").alias("at"))
    every = dict(ids="1,2", time_range=(5, 7), resume_id=90)
    assert scans.select_rows(rows, "k", "at", now=100, period=5, **every).count() == 4
    assert scans.select_rows(rows, "k", "at", **every).count() == 2
    assert scans.select_rows(rows, "k", "at", time_range=(5, 7), resume_id=90).count() == 3
    assert scans.select_rows(rows, "k", "at", resume_id=90).count() == 10
    assert scans.select_rows(rows, "k", "at").count() == 100


def test_disabled_rows_stay_for_listed_entities(frame):
    rows = frame([(1, 0), (2, 1)], "k int, disable int")
    assert scans.enabled_filter(rows, "article").count() == 1
    assert scans.enabled_filter(rows, "media").count() == 2


@pytest.mark.parametrize("size", [1, 7, 100, 1000])
def test_pages_partition_the_keys(spark, size):
    keys = spark.range(0, 300, 3).withColumnRenamed("id", "k")
    pages = sorted(scans.split_plan(keys, "k", size).collect())
    assert sum(p["rows"] for p in pages) == 100
    assert all(p["rows"] == size for p in pages[:-1])
    assert [p["start_key"] for p in pages] == [i * size * 3 for i in range(len(pages))]
    predicates = page_predicates("k", [p["start_key"] for p in pages])
    assert sum(keys.filter(p).count() for p in predicates) == 100


def test_page_limit_cuts_ties_alike_in_any_order(spark):
    keys = spark.range(500).select((F.col("id") * 37 % 50).alias("k"), "id")
    first = rows_of(scans.paged_limit(keys, "k", 20, 4))
    assert rows_of(scans.paged_limit(keys.repartition(7), "k", 20, 4)) == first
    assert len(first) == 80 and max(r[0] for r in first) == 7


@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_value_at_rank(spark, accuracy):
    for scale in (1, 1 << 53):
        numbers = sorted([i * i % 997 * scale for i in range(700)] + [5 * scale] * 300)
        df = spark.createDataFrame([(v,) for v in numbers], "v long").repartition(3)
        for rank in (1, 2, 333, 500, 999, 1000) if scale == 1 else (1, 500):
            value = numbers[rank - 1]
            assert scans.value_at_rank(df, "v", rank, accuracy) == (value, numbers.index(value))
    with pytest.raises(ValueError):
        scans.value_at_rank(df, "v", 1001)


def test_page_limit_with_nulls_repeated_rows_and_all_pages(spark):
    rows = [(None, i) for i in range(10)] + [(1, 1)] * 30 + [(2, i) for i in range(30)] + [(3, 9)]
    df = spark.createDataFrame(rows, "k long, v int").repartition(4)
    order = lambda r: (r[0] is not None, r[0] or 0)
    for wanted in (0, 1, 4, 10, 11, 25, 40, 41, 55, 70, 71, 200):
        got = [tuple(r) for r in scans.paged_limit(df, "k", wanted, 1).collect()]
        assert sorted(map(order, got)) == sorted(map(order, rows))[:wanted]
        assert not set(got) - set(rows) and len(got) - len(set(got)) == max(0, min(30, wanted - 10) - 1)


def test_page_limit_reads_the_key_for_the_cut(spark):
    """The wide table is filtered, not sorted or written."""
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = scans.paged_limit(orders, "o_orderkey", 100, 2)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan.split("xxhash64")[0] and "PushedFilters" in plan


def test_listed_ids_in_the_type_of_the_key(spark):
    texts = spark.createDataFrame([("7",), ("07",), ("10",), ("x",)], "k string")
    assert rows_of(scans.id_list_scan(texts, "k", "7,10")) == [("10",), ("7",)]
    numbers = spark.range(5000).select(F.col("id").cast("int").alias("k"))
    assert scans.id_list_scan(numbers, "k", list(range(0, 9000, 3))).count() == 1667
    assert scans.id_list_scan(numbers, "k", []).count() == 0


def test_range_of_listed_ids_reaches_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderkey")
    plan = scans.id_list_scan(orders, "o_orderkey", "3,70")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderkey,3)" in plan and "LessThanOrEqual(o_orderkey,70)" in plan


def test_resume_filter_reaches_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderkey")
    plan = scans.snapshot_scan(orders, "o_orderkey", 5)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderkey,5)" in plan and "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_streaming_feed_needs_a_schema(spark):
    with pytest.raises(ValueError):
        read_change_feed(spark, "/tmp", streaming=True)


def test_time_bounds_reach_the_scan_of_a_timestamp(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderkey", "o_orderdate")
    recent = scans.incremental_scan(orders, "o_orderdate", now=1_000_000_000, period=100_000_000)
    assert "GreaterThan(o_orderdate,1998-07-09T16:00)" in recent._jdf.queryExecution().executedPlan().toString()
    assert recent.count() == orders.filter("o_orderdate > '1998-07-09 16:00:00'").count() > 0
    ranged = scans.time_range_scan(orders, "o_orderdate", 900_000_000, 950_000_000)
    assert "LessThanOrEqual(o_orde" in ranged._jdf.queryExecution().executedPlan().toString()
