"""Queries over the sources and scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from docweave.plans.fixtures import Tables, V_DOC, V_LOG_LINE, docs_of
from docweave.plans.registry import query, with_views
from docweave.session import fresh_dir
from docweave.sources.scans import (
    enabled_filter,
    id_list_scan,
    incremental_scan,
    paged_limit,
    select_rows,
    snapshot_scan,
    split_plan,
    time_range_scan,
)
from docweave.sources.tables import epoch_seconds, read_change_feed, read_log_text

DAY = 86_400
START, END = 820_454_400, 978_220_800  # 1996-01-01 to 2000-12-31
NOW, PERIOD = 1_005_000_000, 2000 * DAY
IDS = " 3, 7，11,,190 ,1400,"

_DOC_COLUMNS = "id, cust_id, CAST(disable AS BIGINT) AS disable, update_time, create_time, price"


def _doc(t: Tables) -> DataFrame:
    return t.doc.select("id", "cust_id", "disable", "update_time", "create_time", "price")


@query("a1_snapshot_scan", with_views(V_DOC, select=f"SELECT {_DOC_COLUMNS} FROM v_doc WHERE id >= 1"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return snapshot_scan(_doc(Tables(spark, sf)), "id", resume_id=1)


@query("a2_id_list_scan", with_views(V_DOC, select=f"SELECT {_DOC_COLUMNS} FROM v_doc WHERE id IN (3, 7, 11, 190, 1400)"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return id_list_scan(_doc(Tables(spark, sf)), "id", IDS)


@query("a3_time_range_scan", with_views(V_DOC, select=f"SELECT {_DOC_COLUMNS} FROM v_doc WHERE update_time BETWEEN {START} AND {END}"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    rows = time_range_scan(t.table("orders"), "o_orderdate", START, END)
    return docs_of(rows).select("id", "cust_id", "disable", "update_time", "create_time", "price")


@query(
    "a4_incremental_scan",
    f"""SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, CAST(epoch(l_shipdate) AS BIGINT) AS update_time
        FROM lineitem WHERE epoch(l_shipdate) > {NOW} - {PERIOD}""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    line = Tables(spark, sf).line
    rows = incremental_scan(line, "l_shipdate", NOW, PERIOD)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", epoch_seconds(F.col("l_shipdate")).alias("update_time"))


@query(
    "a5_select_rows",
    with_views(
        V_DOC,
        select=f"""
  SELECT 'update' AS mode, id, update_time FROM v_doc WHERE update_time > {NOW} - {PERIOD}
  UNION ALL SELECT 'ids', id, update_time FROM v_doc WHERE id IN (3, 7, 11, 190, 1400)
  UNION ALL SELECT 'range', id, update_time FROM v_doc WHERE update_time BETWEEN {START} AND {END}
  UNION ALL SELECT 'resume', id, update_time FROM v_doc WHERE id >= 10
  UNION ALL SELECT 'full', id, update_time FROM v_doc""",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    doc = Tables(spark, sf).doc.select("id", "update_time")
    span = (START, END)
    modes = {
        "update": dict(now=NOW, period=PERIOD, ids=IDS, time_range=span, resume_id=10),
        "ids": dict(ids=IDS, time_range=span, resume_id=10),
        "range": dict(time_range=span, resume_id=10),
        "resume": dict(resume_id=10),
        "full": {},
    }
    combined = None
    for mode, options in modes.items():
        part = select_rows(doc, "id", "update_time", **options).select(F.lit(mode).alias("mode"), "id", "update_time")
        combined = part if combined is None else combined.unionByName(part)
    return combined


@query(
    "a6_split_plan",
    with_views(
        V_DOC,
        select="""SELECT page_no, min(id) AS start_key, count(*) AS rows
                  FROM (SELECT id, (row_number() OVER (ORDER BY id) - 1) // 1000 AS page_no FROM v_doc) GROUP BY 1""",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return split_plan(Tables(spark, sf).doc, "id", 1000)


@query("a7_paged_limit", with_views(V_DOC, select=f"SELECT {_DOC_COLUMNS} FROM v_doc ORDER BY id LIMIT 3000"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return paged_limit(_doc(Tables(spark, sf)), "id", page_size=1000, page_limit=3)


@query(
    "a8_enabled_filter",
    with_views(
        V_DOC,
        select="""SELECT 'article' AS entity, id, CAST(disable AS BIGINT) AS disable FROM v_doc WHERE disable = 0
                  UNION ALL SELECT 'media', id, CAST(disable AS BIGINT) FROM v_doc""",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    doc = Tables(spark, sf).doc.select("id", "disable")
    parts = [enabled_filter(doc, e).select(F.lit(e).alias("entity"), "id", "disable") for e in ("article", "media")]
    return parts[0].unionByName(parts[1])


@query("a10_change_feed", "SELECT event_id, user_id, event_type, value, props, epoch_us(ts) AS micros FROM events")
def _(spark: SparkSession, sf: str) -> DataFrame:
    feed = read_change_feed(spark, f"{sf}/events.parquet")
    return feed.withColumn("micros", F.unix_micros(F.col("ts").cast("timestamp"))).drop("ts")


@query("a11_log_text", with_views(V_LOG_LINE, select="SELECT line FROM v_log_line"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_dir(spark, "log-text")
    Tables(spark, sf).log_line.select(F.col("line").alias("value")).write.text(path)
    return read_log_text(spark, path)
