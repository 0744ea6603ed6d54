import hashlib
from datetime import datetime, timezone

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from docweave.operators import logs
from docweave.plans.fixtures import Tables

GOOD = {
    0: "06/Jul/2021:15:12:24 +0800 ", 1: " h.example.com ", 2: " 200 ", 6: " 0.250 ", 10: " GET /a/b?x=1&y=2 HTTP/1.1 ", 11: " agent ", 12: " 1.2.3.4, 5.6.7.8 ",
}


def line(**changes):
    fields = {**{i: " - " for i in range(14)}, **GOOD, **{int(k[1:]): v for k, v in changes.items()}}
    return "|".join(fields[i] for i in range(14))


def scan(frame, text, slow_ms=0.0):
    return logs.scan_access_log(frame([(text,)], "line string"), slow_ms).first()


def test_document_fields(frame):
    document = scan(frame, line())["document"]
    at = datetime(2021, 7, 6, 7, 12, 24, tzinfo=timezone.utc)
    digest = f"{int(at.timestamp()) * 10**9} h.example.com GET/a/b?x=1&y=2 200  0.250  agent  1.2.3.4, 5.6.7.8 "
    assert document["id"] == hashlib.md5(digest.encode()).hexdigest()
    assert document["domain"] == "h.example.com" and document["status"] == 200 and document["response_time"] == 250.0
    assert (document["http_method"], document["request_route"], document["request_param"]) == ("GET", "/a/b", "x=1&y=2")
    assert (document["user_agent"], document["real_ip"]) == ("agent", "1.2.3.4")


@pytest.mark.parametrize(
    "changes, reason",
    [
        ({}, None), ({"f0": "06/Jul/2021:15:12:24 +0900 "}, "time"), ({"f0": "32/Jul/2021:15:12:24 +0800 "}, "time"), ({"f0": "soon"}, "time"),
        ({"f10": " GET /x "}, "request"), ({"f10": " GET x HTTP/1.1 "}, "uri"), ({"f10": " GET /%zz HTTP/1.1 "}, "uri"), ({"f2": " 2x "}, "status"),
        ({"f6": " - "}, "response time"), ({"f0": "soon", "f2": "x", "f6": "-"}, "time"),
    ],
)
def test_first_failing_reason(frame, changes, reason):
    row = scan(frame, line(**changes))
    assert row["reject_reason"] == reason and (row["document"] is None) == (reason is not None)


@pytest.mark.parametrize("text", ["", "a|b", line() + "|more"])
def test_field_count(frame, text):
    assert scan(frame, text)["reject_reason"] == "field count"


@pytest.mark.parametrize(
    "uri, path, query",
    [
        ("/a%20b+c", "/a b+c", ""), ("/p#frag?q=1#z", "/p#frag", "q=1#z"), ("http://h:80/x/y?z", "/x/y", "z"), ("https://h", "", ""), ("/a?b?c", "/a", "b?c"), ("/", "/", ""),
    ],
)
def test_uri_parts(frame, uri, path, query):
    document = scan(frame, line(f10=f" GET {uri} HTTP/1.1 "))["document"]
    assert (document["request_route"], document["request_param"]) == (path, query)


def test_threshold_is_inclusive(frame):
    assert scan(frame, line(), slow_ms=250)["document"] is not None
    assert scan(frame, line(), slow_ms=251)["document"] is None
    assert scan(frame, line(), slow_ms=251)["reject_reason"] is None


def test_valid_and_rejected_lines_are_the_input(spark):
    lines = Tables(spark, "/root/testdata/sf0.001").log_line
    scanned = logs.scan_access_log(lines)
    assert logs.log_documents(scanned).count() + logs.log_rejects(scanned).count() == lines.count()


def test_queue_skips_bad_json(spark, frame):
    documents = logs.parse_access_log(frame([(line(),)], "line string"))
    payloads = logs.to_queue(documents).unionByName(frame([("{oops",)], "payload string"))
    assert rows_of(logs.from_queue(payloads)) == rows_of(documents)


def test_month_is_the_one_of_the_event_at_utc_plus_8(one):
    assert one(logs.log_month(F.lit("2024-01-31 16:00:00"))) == "202402"
    assert one(logs.log_month(F.lit("2024-01-31 15:59:59"))) == "202401"


def test_a_large_month_is_split_over_files(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        rows = spark.range(200_000).select(F.col("id"), F.timestamp_seconds(1_704_100_000 + F.col("id") % 3).alias("request_time"))
        logs.write_monthly(rows.repartition(8), str(tmp_path / "m"), "one")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "m" / "batch=one" / "month=202401").glob("part-*"))) > 1
    assert spark.read.parquet(str(tmp_path / "m")).count() == 200_000
