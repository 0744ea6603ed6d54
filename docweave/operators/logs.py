"""Web access log: parsing with reject reasons, slow requests, ids and monthly output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType, TimestampType

from docweave.functions.json_fields import enclosed, valid_json

FIELD_COUNT = 14
# Positions of the fields that are used (fixed values).
TIME, HOST, STATUS, RESPONSE, REQUEST, AGENT, FORWARDED = 0, 1, 2, 6, 10, 11, 12
_TIME_SHAPE = r"^\d{2}/[A-Z][a-z]{2}/\d{4}:\d{2}:\d{2}:\d{2} \+0800$"
_TIME_PATTERN = "dd/MMM/yyyy:HH:mm:ss Z"
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"
_ABSOLUTE_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/?]*)?(/[^?]*)?"
_BAD_ESCAPE = r"%(?![0-9A-Fa-f]{2})"
_FLOAT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

LOG_SCHEMA = StructType(
    [
        StructField("id", StringType()),
        StructField("request_time", TimestampType()),
        StructField("domain", StringType()),
        StructField("http_method", StringType()),
        StructField("request_route", StringType()),
        StructField("request_param", StringType()),
        StructField("status", IntegerType()),
        StructField("response_time", DoubleType()),
        StructField("user_agent", StringType()),
        StructField("real_ip", StringType()),
    ]
)


def _path(uri: Column) -> Column:
    """Decoded path of a request URI; NULL where the URI is not valid."""
    raw = F.when(uri.startswith("/"), F.substring_index(uri, "?", 1)).when(
        uri.rlike(_SCHEME), F.regexp_extract(uri, _ABSOLUTE_PATH, 1)
    )
    decoded = F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
    return F.when(raw.contains("%"), F.when(~raw.rlike(_BAD_ESCAPE), decoded)).otherwise(raw)


def _query(uri: Column) -> Column:
    at = F.locate("?", uri)
    return F.when(at > 0, F.substring(uri, at + 1, F.length(uri))).otherwise(F.lit(""))


def _log_id() -> Column:
    """Digest of time in nanoseconds and the untrimmed fields of a line."""
    nanos = (F.unix_seconds("_at") * F.lit(1_000_000_000)).cast("string")
    parts = [nanos, "_host", F.get("_request", F.lit(0)), "_uri", "_status", "_response", "_agent", "_forwarded"]
    return F.md5(F.concat(*parts).cast("binary"))


def scan_access_log(lines: DataFrame, slow_ms: float = 0.0, line: str = "line") -> DataFrame:
    """Every line with ``reject_reason``, the first test that failed, and its ``document``.

    The document is NULL for rejected lines and for those faster than ``slow_ms`` milliseconds. Each
    step is a projection of its own whose values are used several times below, so that nothing is
    parsed twice.
    """
    fields = lines.select(F.col(line), F.split(F.col(line), r"\|", -1).alias("_f"))

    def field(index: int) -> Column:
        return F.get(F.col("_f"), F.lit(index))

    parts = fields.select(
        line,
        F.size("_f").alias("_n"),
        F.trim(field(TIME)).alias("_time"),
        field(HOST).alias("_host"),
        field(STATUS).alias("_status"),
        field(RESPONSE).alias("_response"),
        F.split(F.trim(field(REQUEST)), " ").alias("_request"),
        field(AGENT).alias("_agent"),
        field(FORWARDED).alias("_forwarded"),
    )
    uri = F.get(F.col("_request"), F.lit(1))
    seconds = F.trim(F.col("_response"))
    values = parts.select(
        "*",
        F.when(F.col("_time").rlike(_TIME_SHAPE), F.try_to_timestamp("_time", F.lit(_TIME_PATTERN))).alias("_at"),
        uri.alias("_uri"),
        _path(uri).alias("_path"),
        F.trim("_status").try_cast("int").alias("_code"),
        F.when(seconds.rlike(_FLOAT), seconds.try_cast("double")).alias("_seconds"),
    )
    reason = (
        F.when(F.col("_n") != FIELD_COUNT, "field count")
        .when(F.col("_at").isNull(), "time")
        .when(F.size("_request") != 3, "request")
        .when(F.col("_path").isNull(), "uri")
        .when(F.col("_code").isNull(), "status")
        .when(F.col("_seconds").isNull(), "response time")
    )
    judged = values.withColumn("reject_reason", reason)
    document = F.struct(
        _log_id().alias("id"),
        F.col("_at").alias("request_time"),
        F.trim("_host").alias("domain"),
        F.get("_request", F.lit(0)).alias("http_method"),
        F.col("_path").alias("request_route"),
        _query(F.col("_uri")).alias("request_param"),
        F.col("_code").alias("status"),
        (F.col("_seconds") * 1000).alias("response_time"),
        F.trim("_agent").alias("user_agent"),
        F.substring_index(F.trim("_forwarded"), ",", 1).alias("real_ip"),
    )
    wanted = F.col("reject_reason").isNull() & (F.col("_seconds") >= F.lit(slow_ms / 1000.0))
    return judged.select(line, "reject_reason", F.when(wanted, document).alias("document"))


def log_rejects(scanned: DataFrame, line: str = "line") -> DataFrame:
    """Bad lines and why they are bad."""
    # a generator instead of a filter: a pushed-down filter would run the whole parse a second time
    bad = F.when(F.col("reject_reason").isNotNull(), F.array(F.struct(line, "reject_reason")))
    return scanned.select(F.inline(bad))


def log_documents(scanned: DataFrame) -> DataFrame:
    """Documents of the lines that have one."""
    return scanned.select(F.inline(F.when(F.col("document").isNotNull(), F.array("document"))))


def parse_access_log(lines: DataFrame, slow_ms: float = 0.0, line: str = "line") -> DataFrame:
    """Documents of the valid lines that took at least ``slow_ms`` milliseconds."""
    return log_documents(scan_access_log(lines, slow_ms, line))


def log_upsert(documents: DataFrame) -> DataFrame:
    """One document per id; the id covers all fields, so replayed lines are equal."""
    return documents.dropDuplicates(["id"])


def to_queue(documents: DataFrame) -> DataFrame:
    """Documents as JSON payloads."""
    return documents.select(F.to_json(F.struct(*documents.columns)).alias("payload"))


def from_queue(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Documents of JSON payloads; bad JSON is skipped."""
    text = F.col(payload)
    usable = F.when(enclosed(text, "{", "}"), valid_json(text)).otherwise(False)
    return payloads.select(F.inline(F.when(usable, F.array(F.from_json(text, LOG_SCHEMA)))))


def log_month(ts: Column) -> Column:
    """``yyyyMM`` of the event at UTC+8."""
    return F.date_format(ts.cast("timestamp") + F.expr("INTERVAL 8 HOURS"), "yyyyMM")


def write_monthly(documents: DataFrame, path: str, batch: str, ts: str = "request_time") -> None:
    """The documents of one batch into a folder per month and batch; the same batch again replaces only itself.

    The rebalance keeps the files of a month together, splits a month that is too large for a task
    and merges small ones.
    """
    monthly = documents.withColumn("month", log_month(F.col(ts)))
    monthly.hint("rebalance", F.col("month")).write.mode("overwrite").partitionBy("month").parquet(f"{path}/batch={batch}")


def read_monthly(spark: SparkSession, path: str, month: str | None = None) -> DataFrame:
    """The documents of all batches or of one month, each id once: an upsert, resolved on read inside the month."""
    found = spark.read.option("basePath", path).parquet(path).withColumn("month", F.col("month").cast("string"))
    if month is not None:
        found = found.filter(F.col("month") == month)
    return found.drop("batch").dropDuplicates(["month", "id"])
