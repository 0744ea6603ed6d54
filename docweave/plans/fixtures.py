"""The given tables seen as media rows, bridges, change feeds and log lines, in Spark and in SQL."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docweave.sources.tables import epoch_seconds, read_table


class Tables:
    """The given Parquet tables and the views derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.dir}/{name}.parquet")

    @cached_property
    def doc(self) -> DataFrame:
        """Orders as documents."""
        return docs_of(self.table("orders"))

    @cached_property
    def media(self) -> DataFrame:
        """Documents with the text columns that hold lists and JSON."""
        key = F.col("id")
        number = key.cast("string")
        return _spread(self.doc, "id").withColumnsRenamed({"cust_id": "channel_id"}).withColumns(
            {
                "vip_type": F.when(key % 4 == 0, "").otherwise("vip"),
                "extend": extend_json(key, number),
                "payment_info": payment_json(key, number),
                "corner_type": F.when(key % 3 == 0, "").otherwise(F.concat(F.lit("new,c"), (key % 7).cast("string"))),
                "language_media_id": F.when(key % 2 == 0, F.lit(0)).otherwise(key - key % 3),
                "original_id": F.when(key % 5 == 0, F.concat(F.lit("x"), number)).otherwise(number),
            }
        )

    @cached_property
    def line(self) -> DataFrame:
        return self.table("lineitem")

    @cached_property
    def part(self) -> DataFrame:
        return _spread(self.table("part"), "p_partkey")

    @cached_property
    def tag_bridge(self) -> DataFrame:
        return self.line.select(F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("part_id"))

    @cached_property
    def tag_pairs(self) -> DataFrame:
        """(document, tag) through the parts of a document."""
        parts = self.table("part").select(F.col("p_partkey").alias("part_id"), brand_number().alias("tag_id"))
        return self.tag_bridge.join(parts, "part_id").select("id", "tag_id")

    @cached_property
    def tag(self) -> DataFrame:
        return self.table("part").select(brand_number().alias("tag_id"), F.col("p_brand").alias("tag_name")).distinct()

    @cached_property
    def category_pairs(self) -> DataFrame:
        parts = self.table("part").select(F.col("p_partkey").alias("part_id"), F.col("p_size").cast("long").alias("category_id"))
        return self.tag_bridge.join(parts, "part_id").select("id", "category_id")

    @cached_property
    def category(self) -> DataFrame:
        """Sizes as categories; the standard id is not in the order of the id."""
        size = F.col("p_size").cast("long")
        return (
            self.table("part").select(size.alias("category_id")).distinct()
            .withColumn("category_name", F.concat(F.lit("size "), F.col("category_id").cast("string")))
            .withColumn("standard_cate_id", F.col("category_id") * 7 % 53)
        )

    @cached_property
    def area_pairs(self) -> DataFrame:
        suppliers = self.table("supplier").select("s_suppkey", F.col("s_nationkey").cast("long").alias("area_id"))
        lines = self.line.select(F.col("l_orderkey").alias("id"), "l_suppkey")
        return lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).select("id", "area_id")

    @cached_property
    def area(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").cast("long").alias("area_id"),
            F.col("n_name").alias("area_name"),
            F.col("n_regionkey").cast("long").alias("standard_area_id"),
        )

    @cached_property
    def person_bridge(self) -> DataFrame:
        return self.line.select(
            F.col("l_orderkey").alias("id"), F.col("l_suppkey").alias("person_id"), F.col("l_quantity").cast("long").alias("priority")
        )

    @cached_property
    def director_bridge(self) -> DataFrame:
        """The return flag takes the place of the director's bridge table."""
        return self.line.filter(F.col("l_returnflag") == "R").select(
            F.col("l_orderkey").alias("id"), F.col("l_suppkey").alias("person_id"), F.col("l_linenumber").cast("long").alias("priority")
        )

    @cached_property
    def person(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("person_id"),
            F.col("s_name").alias("person_name"),
            F.floor("s_acctbal").cast("long").alias("apriority"),
        )

    @cached_property
    def child(self) -> DataFrame:
        """Line items as episodes."""
        return self.line.select(
            F.col("l_orderkey").alias("id"),
            F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("disable"),
            epoch_seconds(F.col("l_shipdate")).alias("child_time"),
        )

    @cached_property
    def channel(self) -> DataFrame:
        nation = self.table("nation").select("n_nationkey", F.col("n_name").alias("channel_name"))
        customer = self.table("customer").select(
            F.col("c_custkey").alias("channel_id"), F.col("c_mktsegment").alias("channel_code"), "c_nationkey"
        )
        return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
            "channel_id", "channel_name", "channel_code"
        )

    @cached_property
    def change(self) -> DataFrame:
        return changes_of(self.table("events"))

    @cached_property
    def log_line(self) -> DataFrame:
        return log_lines_of(_spread(self.table("events"), "event_id"))

    @cached_property
    def documents(self) -> DataFrame:
        return _spread(self.table("documents").select("doc_id", "text"), "doc_id")


def _spread(df: DataFrame, key: str) -> DataFrame:
    """One small test file is read by one task; spread its rows where there are fewer files than cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if len(df.inputFiles()) < cores else df


def docs_of(orders: DataFrame) -> DataFrame:
    """Orders as documents."""
    updated = epoch_seconds(F.col("o_orderdate"))
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("cust_id"),
        F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("disable"),
        updated.alias("update_time"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit(0)).otherwise(updated - 3600).alias("create_time"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderstatus").alias("source"),
    )


def brand_number() -> Column:
    return F.regexp_extract("p_brand", r"(\d+)$", 1).cast("long")


def extend_json(key: Column, number: Column) -> Column:
    """Extension JSON with all the forms that mean "none", and broken JSON."""
    full = F.concat(
        F.lit('{"show_brands":"b'), (key % 5).cast("string"), F.lit(', b'), (key % 3).cast("string"),
        F.lit(',","hide_brands":" h'), (key % 4).cast("string"), F.lit('","show_strategy":"'), number,
        F.lit(',x7, 12","hide_strategy":"","edu_priority":"'), (key % 9).cast("string"), F.lit('"}'),
    )
    return (
        F.when(key % 13 == 0, "").when(key % 13 == 1, "[]").when(key % 13 == 2, "0")
        .when(key % 13 == 3, F.concat(F.lit('{"show_brands":"b'), number)).otherwise(full)
    )


def payment_json(key: Column, number: Column) -> Column:
    full = F.concat(
        F.lit('[{"brand":'), (key % 3).cast("string"), F.lit(',"payment":"p'), (key % 6).cast("string"),
        F.lit('"},{"brand":'), (key % 17 + 1).cast("string"), F.lit(',"payment":"free"},{"brand":12},{"brand":'),
        (key % 19 + 3).cast("string"), F.lit(',"payment":"vip"}]'),
    )
    return F.when(key % 10 == 0, "").when(key % 10 == 1, F.concat(F.lit("[{"), number)).otherwise(full)


def changes_of(events: DataFrame) -> DataFrame:
    """Events as row changes."""
    kind = F.col("event_type")
    return events.select(
        F.concat(F.lit("log."), F.date_format("ts", "yyyyMMdd")).alias("file"),
        F.col("event_id").alias("pos"),
        F.concat(F.lit("db_app"), (F.col("user_id") % 3).cast("string"), F.lit("_media")).alias("db"),
        F.concat(F.lit("FM_"), kind).alias("tbl"),
        F.when(kind == "signup", "insert").when(kind == "error", "delete").otherwise("update").alias("action"),
        F.col("user_id").cast("string").alias("key"),
        "user_id",
        "event_type",
        "value",
        "props",
        epoch_seconds(F.col("ts")).alias("event_time"),
    )


def log_lines_of(events: DataFrame) -> DataFrame:
    """Events as access-log lines, some of them broken in each possible way."""
    key, number = F.col("event_id"), F.col("event_id").cast("string")
    local = F.date_format(F.col("ts") + F.expr("INTERVAL 8 HOURS"), "dd/MMM/yyyy:HH:mm:ss")
    seconds = F.when(key % 37 == 0, "-").otherwise(F.col("value").cast("string"))
    status = F.when(key % 47 == 0, "abc").otherwise((key % 5 * 100 + 100).cast("string"))
    uri = (
        F.when(key % 31 == 0, "no-slash").when(key % 29 == 0, "/bad%zz/path")
        .when(key % 23 == 0, F.concat(F.lit("http://h"), number, F.lit(".example.com/abs?x=1")))
        .otherwise(F.concat(F.lit("/v1/"), F.col("event_type"), F.lit("/a%20b+c?user="), F.col("user_id").cast("string")))
    )
    request = F.when(key % 41 == 0, "GET").otherwise(F.concat(F.lit("GET "), uri, F.lit(" HTTP/1.1")))
    parts = [
        F.when(key % 53 == 0, F.lit("bad time ")).otherwise(F.concat(local, F.lit(" +0800 "))),
        F.concat(F.lit(" h"), (F.col("user_id") % 3).cast("string"), F.lit(".example.com ")),
        F.concat(F.lit(" "), status, F.lit(" ")),
        F.lit(" 512 "),
        F.lit(" 2048 "),
        F.lit(" 10.0.0.1:80 "),
        F.concat(F.lit(" "), seconds, F.lit(" ")),
        F.lit(" - "),
        F.lit(" 10.1.1.1 "),
        F.lit(" - "),
        F.concat(F.lit(" "), request, F.lit(" ")),
        F.concat(F.lit(" agent/"), (key % 7).cast("string"), F.lit(" ")),
        F.concat(F.lit(" 172.16.0."), (key % 250).cast("string"), F.lit(", 10.9.9.9 ")),
    ]
    last = F.when(key % 43 == 0, F.lit(None).cast("string")).otherwise(F.lit(" fn"))
    return events.select(F.concat_ws("|", *parts, last).alias("line"))


# The same views in SQL.

V_DOC = """v_doc AS (
  SELECT o_orderkey AS id, o_custkey AS cust_id, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS disable,
         CAST(epoch(o_orderdate) AS BIGINT) AS update_time,
         CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE CAST(epoch(o_orderdate) AS BIGINT) - 3600 END AS create_time,
         o_totalprice AS price, o_orderpriority AS name, o_orderstatus AS source
  FROM orders)"""

V_MEDIA = """v_media AS (
  SELECT *, cust_id AS channel_id, CASE WHEN id % 4 = 0 THEN '' ELSE 'vip' END AS vip_type,
         CASE WHEN id % 13 = 0 THEN '' WHEN id % 13 = 1 THEN '[]' WHEN id % 13 = 2 THEN '0'
              WHEN id % 13 = 3 THEN '{"show_brands":"b' || id
              ELSE '{"show_brands":"b' || (id % 5) || ', b' || (id % 3) || ',","hide_brands":" h' || (id % 4)
                   || '","show_strategy":"' || id || ',x7, 12","hide_strategy":"","edu_priority":"' || (id % 9) || '"}' END AS extend,
         CASE WHEN id % 10 = 0 THEN '' WHEN id % 10 = 1 THEN '[{' || id
              ELSE '[{"brand":' || (id % 3) || ',"payment":"p' || (id % 6) || '"},{"brand":' || (id % 17 + 1)
                   || ',"payment":"free"},{"brand":12},{"brand":' || (id % 19 + 3) || ',"payment":"vip"}]' END AS payment_info,
         CASE WHEN id % 3 = 0 THEN '' ELSE 'new,c' || (id % 7) END AS corner_type,
         CASE WHEN id % 2 = 0 THEN 0 ELSE id - id % 3 END AS language_media_id,
         CASE WHEN id % 5 = 0 THEN 'x' || id ELSE CAST(id AS VARCHAR) END AS original_id
  FROM v_doc)"""

V_TAG = """v_tag AS (
  SELECT DISTINCT l_orderkey AS id, CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS BIGINT) AS tag_id, p_brand AS tag_name
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

V_CATEGORY = """v_category AS (
  SELECT DISTINCT l_orderkey AS id, CAST(p_size AS BIGINT) AS category_id, 'size ' || p_size AS category_name,
         CAST(p_size AS BIGINT) * 7 % 53 AS standard_cate_id
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

V_AREA = """v_area AS (
  SELECT DISTINCT l_orderkey AS id, CAST(n_nationkey AS BIGINT) AS area_id, n_name AS area_name,
         CAST(n_regionkey AS BIGINT) AS standard_area_id
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""

V_PERSON = """v_person AS (
  SELECT l_orderkey AS id, l_suppkey AS person_id, s_name AS person_name, max(CAST(l_quantity AS BIGINT)) AS priority,
         CAST(floor(max(s_acctbal)) AS BIGINT) AS apriority
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3)"""

V_DIRECTOR = """v_director AS (
  SELECT l_orderkey AS id, l_suppkey AS person_id, s_name AS person_name, max(CAST(l_linenumber AS BIGINT)) AS priority,
         CAST(floor(max(s_acctbal)) AS BIGINT) AS apriority
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_returnflag = 'R' GROUP BY 1, 2, 3)"""

V_CHILD = """v_child AS (
  SELECT l_orderkey AS id, CAST(epoch(max(l_shipdate)) AS BIGINT) AS newest FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1)"""

V_CHANNEL = """v_channel AS (
  SELECT c_custkey AS channel_id, n_name AS channel_name, c_mktsegment AS channel_code
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

V_CHANGE = """v_change AS (
  SELECT 'log.' || strftime(ts, '%Y%m%d') AS file, event_id AS pos, 'db_app' || (user_id % 3) || '_media' AS db,
         'FM_' || event_type AS tbl,
         CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete' ELSE 'update' END AS action,
         CAST(user_id AS VARCHAR) AS key, user_id, event_type, value, props, CAST(floor(epoch(ts)) AS BIGINT) AS event_time,
         'app' || (user_id % 3) || '_' || event_type AS base
  FROM events)"""

V_LOG_LINE = """v_log_line AS (
  SELECT CASE WHEN event_id % 53 = 0 THEN 'bad time ' ELSE strftime(ts + INTERVAL 8 HOUR, '%d/%b/%Y:%H:%M:%S') || ' +0800 ' END
         || '| h' || (user_id % 3) || '.example.com | '
         || CASE WHEN event_id % 47 = 0 THEN 'abc' ELSE CAST(event_id % 5 * 100 + 100 AS VARCHAR) END
         || ' | 512 | 2048 | 10.0.0.1:80 | ' || CASE WHEN event_id % 37 = 0 THEN '-' ELSE CAST(value AS VARCHAR) END
         || ' | - | 10.1.1.1 | - | '
         || CASE WHEN event_id % 41 = 0 THEN 'GET' ELSE 'GET '
              || CASE WHEN event_id % 31 = 0 THEN 'no-slash' WHEN event_id % 29 = 0 THEN '/bad%zz/path'
                      WHEN event_id % 23 = 0 THEN 'http://h' || event_id || '.example.com/abs?x=1'
                      ELSE '/v1/' || event_type || '/a%20b+c?user=' || user_id END || ' HTTP/1.1' END
         || ' | agent/' || (event_id % 7) || ' | 172.16.0.' || (event_id % 250) || ', 10.9.9.9 '
         || CASE WHEN event_id % 43 = 0 THEN '' ELSE '| fn' END AS line
  FROM events)"""

# Access-log lines parsed in SQL.
V_LOG = """v_fields AS (SELECT line, string_split(line, '|') AS f FROM v_log_line),
v_parts AS (
  SELECT line, len(f) AS n, trim(f[1], ' ') AS t, f[2] AS host, f[3] AS st, f[7] AS resp,
         string_split(trim(f[11], ' '), ' ') AS req, f[12] AS agent, f[13] AS fwd FROM v_fields),
v_uri AS (SELECT *, req[2] AS uri, split_part(req[2], '?', 1) AS upath FROM v_parts),
v_scan AS (
  SELECT *, try_strptime(replace(t, ' +0800', ''), '%d/%b/%Y:%H:%M:%S') - INTERVAL 8 HOUR AS logged,
         TRY_CAST(trim(st, ' ') AS INTEGER) AS code, TRY_CAST(trim(resp, ' ') AS DOUBLE) AS seconds,
         CASE WHEN upath LIKE '%\\%zz%' ESCAPE '\\' THEN NULL
              WHEN starts_with(uri, '/') THEN replace(upath, '%20', ' ')
              WHEN regexp_matches(uri, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN regexp_extract(uri, '^[a-z]+://[^/?]*(/[^?]*)', 1) END AS path
  FROM v_uri),
v_log AS (
  SELECT *, CASE WHEN n <> 14 THEN 'field count' WHEN logged IS NULL OR NOT ends_with(t, ' +0800') THEN 'time'
                 WHEN len(req) <> 3 THEN 'request' WHEN path IS NULL THEN 'uri' WHEN code IS NULL THEN 'status'
                 WHEN seconds IS NULL THEN 'response time' END AS reason,
         md5(CAST(epoch(logged) AS BIGINT) * 1000000000 || host || req[1] || uri || st || resp || agent || fwd) AS id,
         trim(host, ' ') AS domain, req[1] AS http_method, path AS request_route,
         CASE WHEN uri LIKE '%?%' THEN substr(uri, strpos(uri, '?') + 1) ELSE '' END AS request_param,
         trim(agent, ' ') AS user_agent, split_part(trim(fwd, ' '), ',', 1) AS real_ip
  FROM v_scan)"""
