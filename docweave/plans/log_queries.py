"""Queries over the access log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from docweave.operators import logs
from docweave.plans.fixtures import Tables, V_LOG, V_LOG_LINE
from docweave.plans.registry import query, with_views

SLOW_MS = 20_000
DOCUMENT_SQL = """id, CAST(epoch(logged) AS BIGINT) AS request_time, domain, http_method, request_route, request_param,
  CAST(code AS BIGINT) AS status, seconds * 1000 AS response_time, user_agent, real_ip"""


def printable(documents: DataFrame) -> DataFrame:
    """Documents with the time as epoch seconds."""
    return documents.withColumn("request_time", F.unix_timestamp("request_time"))


@query("j1_parse_access_log", with_views(V_LOG_LINE, V_LOG, select=f"SELECT {DOCUMENT_SQL} FROM v_log WHERE reason IS NULL"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return printable(logs.parse_access_log(Tables(spark, sf).log_line))


@query("j2_log_rejects", with_views(V_LOG_LINE, V_LOG, select="SELECT line, reason AS reject_reason FROM v_log WHERE reason IS NOT NULL"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return logs.log_rejects(logs.scan_access_log(Tables(spark, sf).log_line))


@query(
    "j3_slow_requests",
    with_views(V_LOG_LINE, V_LOG, select=f"SELECT {DOCUMENT_SQL} FROM v_log WHERE reason IS NULL AND seconds >= {SLOW_MS / 1000}"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return printable(logs.parse_access_log(Tables(spark, sf).log_line, slow_ms=SLOW_MS))


@query("j4_log_id", with_views(V_LOG_LINE, V_LOG, select="SELECT line, id FROM v_log WHERE reason IS NULL"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    scanned = logs.scan_access_log(Tables(spark, sf).log_line)
    found = F.when(F.col("document").isNotNull(), F.array(F.struct("line", F.col("document.id").alias("id"))))
    return scanned.select(F.inline(found))


@query("j5_log_upsert", with_views(V_LOG_LINE, V_LOG, select=f"SELECT DISTINCT {DOCUMENT_SQL} FROM v_log WHERE reason IS NULL"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    lines = Tables(spark, sf).log_line
    return printable(logs.log_upsert(logs.parse_access_log(lines.unionByName(lines))))


@query("j6_log_json", with_views(V_LOG_LINE, V_LOG, select=f"SELECT {DOCUMENT_SQL} FROM v_log WHERE reason IS NULL"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Documents through the queue, among payloads that are not JSON."""
    lines = Tables(spark, sf).log_line
    broken = lines.select(F.concat(F.lit("{"), "line", F.lit("}")).alias("payload"))
    queued = logs.to_queue(logs.parse_access_log(lines))
    return printable(logs.from_queue(queued.unionByName(broken)))
