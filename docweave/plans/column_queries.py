"""Queries over the column functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ByteType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from docweave.functions import convert, json_fields, naming
from docweave.operators.mapping import conform_to_mapping
from docweave.plans.fixtures import Tables, V_CHANGE, V_DOC, V_MEDIA, brand_number
from docweave.plans.registry import query, with_views

PROPS = "k bigint"
TYPED = StructType(
    [
        StructField("id", LongType()),
        StructField("k", IntegerType()),
        StructField("flag", ByteType()),
        StructField("value", DoubleType()),
        StructField("name", StringType()),
        StructField("absent", LongType()),
    ]
)


@query(
    "b1_coerce_rows",
    """SELECT event_id AS id, CASE WHEN event_id % 7 = 0 THEN 0 ELSE CAST(props->>'$.k' AS BIGINT) END AS k,
              CASE WHEN event_id % 300 > 127 THEN 0 ELSE event_id % 300 END AS flag,
              CASE WHEN event_id % 5 = 0 THEN 0 ELSE value END AS value,
              CASE WHEN event_id % 9 = 0 THEN '' ELSE event_type END AS name, CAST(0 AS BIGINT) AS absent FROM events""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("event_id")
    texts = Tables(spark, sf).table("events").select(
        key.cast("string").alias("id"),
        F.when(key % 7 == 0, "n/a").otherwise(F.get_json_object("props", "$.k")).alias("k"),
        (key % 300).cast("string").alias("flag"),
        F.when(key % 5 == 0, "1,5").otherwise(F.col("value").cast("string")).alias("value"),
        F.when(key % 9 != 0, F.col("event_type")).alias("name"),
    )
    return convert.coerce_rows(texts, TYPED)


@query("b2_project_columns", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(spark: SparkSession, sf: str) -> DataFrame:
    orders = Tables(spark, sf).table("orders")
    included = convert.project_columns(orders, include=["O_CUSTKEY", "o_totalprice", "o_orderpriority"], keys=["o_orderkey"])
    return convert.project_columns(included, exclude=["o_orderkey", "o_orderpriority"], keys=["o_orderkey"])


@query(
    "b3_null_fallback",
    with_views(
        V_CHANGE,
        select="""SELECT pos, action, CASE WHEN pos % 3 <> 0 THEN value WHEN action = 'update' THEN CAST(pos AS DOUBLE) END AS value
                  FROM v_change""",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    new = F.when(F.col("pos") % 3 != 0, F.col("value"))
    old = F.col("pos").cast("double")
    return Tables(spark, sf).change.select("pos", "action", convert.null_fallback(new, old, F.col("action")).alias("value"))


@query(
    "b4_enum_label",
    """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey,
              CASE l_linenumber WHEN 1 THEN 'air' WHEN 2 THEN 'rail' WHEN 3 THEN 'road' WHEN 4 THEN 'sea' ELSE '' END AS label
       FROM lineitem""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    label = convert.enum_label(F.col("l_linenumber"), ["air", "rail", "road", "sea"])
    return Tables(spark, sf).line.select("l_orderkey", "l_linenumber", "l_partkey", label.alias("label"))


@query(
    "b5_set_labels",
    """SELECT p_partkey, concat_ws(',', CASE WHEN p_size & 1 > 0 THEN 'a' END, CASE WHEN p_size & 2 > 0 THEN 'b' END,
              CASE WHEN p_size & 4 > 0 THEN 'c' END, CASE WHEN p_size & 8 > 0 THEN 'd' END,
              CASE WHEN p_size & 16 > 0 THEN 'e' END) AS labels FROM part""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    labels = convert.set_labels(F.col("p_size"), ["a", "b", "c", "d", "e"])
    return Tables(spark, sf).table("part").select("p_partkey", labels.alias("labels"))


@query("b6_bit_to_int", "SELECT event_id, CAST(event_id % 3 = 0 AS BIGINT) AS bit FROM events")
def _(spark: SparkSession, sf: str) -> DataFrame:
    byte = F.when(F.col("event_id") % 3 == 0, F.lit("\x01")).otherwise(F.lit("\x00"))
    return Tables(spark, sf).table("events").select("event_id", convert.bit_to_int(byte).alias("bit"))


@query(
    "b7_json_value",
    """SELECT event_id, CASE WHEN event_id % 6 = 0 THEN NULL ELSE CAST(props->>'$.k' AS BIGINT) END AS k,
              CASE WHEN event_id % 6 = 0 THEN props || ']' END AS raw FROM events""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("event_id") % 6 == 0, F.concat("props", F.lit("]"))).otherwise(F.col("props"))
    parsed = Tables(spark, sf).table("events").select("event_id", json_fields.json_value(text, PROPS).alias("json"))
    return parsed.select("event_id", "json.value.k", "json.raw")


@query(
    "b8_reformat_datetime",
    """SELECT event_id, CASE WHEN event_id % 8 < 2 THEN NULL ELSE strftime(ts, '%Y%m%d-%H%M') END AS at,
              CASE event_id % 8 WHEN 0 THEN 'soon' WHEN 1 THEN '0000-00-00 00:00:00' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS text
       FROM events""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    case = F.col("event_id") % 8
    text = F.when(case == 0, "soon").when(case == 1, "0000-00-00 00:00:00").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    rows = Tables(spark, sf).table("events").select("event_id", text.alias("raw"))
    return rows.select(
        "event_id",
        convert.reformat_datetime(F.col("raw"), "yyyyMMdd-HHmm").alias("at"),
        convert.reformat_datetime(F.col("raw"), None).alias("text"),
    )


@query(
    "b9_reformat_date",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE strftime(o_orderdate, '%d.%m.%Y') END AS day FROM orders""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("o_orderkey") % 9 == 0, "0001-01-01").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return Tables(spark, sf).table("orders").select("o_orderkey", convert.reformat_date(text, "dd.MM.yyyy").alias("day"))


@query(
    "b10_number_value",
    """SELECT event_id, CASE WHEN event_id % 4 < 2 THEN NULL ELSE CAST(props->>'$.k' AS BIGINT) END AS number,
              CASE WHEN event_id % 5 < 2 THEN NULL ELSE value END AS amount FROM events""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("event_id")
    whole, decimal = F.get_json_object("props", "$.k"), F.col("value").cast("string")
    number = F.when(key % 4 == 0, "12x").when(key % 4 == 1, F.concat(whole, F.lit(" "))).otherwise(whole)
    amount = F.when(key % 5 == 0, "-").when(key % 5 == 1, F.concat(decimal, F.lit("f"))).otherwise(decimal)
    return Tables(spark, sf).table("events").select(
        "event_id", convert.number_value(number).alias("number"), convert.decimal_value(amount).alias("amount")
    )


@query(
    "b11_text_key",
    """SELECT o_orderkey, regexp_replace(CAST(o_totalprice AS VARCHAR), '\\.0$', '') AS price,
              CAST(CAST(o_totalprice * 100000 AS HUGEINT) AS VARCHAR) AS large, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END, '') AS label,
              '{"k":' || o_custkey || ',"s":"' || o_orderstatus || '"}' AS nested FROM orders""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    nested = F.struct(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("s"))
    return Tables(spark, sf).table("orders").select(
        "o_orderkey",
        convert.text_key(F.col("o_totalprice"), "double").alias("price"),
        convert.text_key(F.round(F.col("o_totalprice") * 100000), "double").alias("large"),
        convert.text_key(F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")), "string").alias("label"),
        convert.text_key(nested, "struct").alias("nested"),
    )


@query("b12_safe_score", "SELECT event_id, CASE WHEN event_id % 5 = 0 OR event_id % 7 < 2 THEN 0 ELSE value END AS score FROM events")
def _(spark: SparkSession, sf: str) -> DataFrame:
    number = F.col("value").cast("string")
    text = F.when(F.col("event_id") % 5 == 0, F.col("event_type")).when(F.col("event_id") % 7 == 0, F.concat(number, F.lit("d")))
    text = text.when(F.col("event_id") % 7 == 1, F.concat(F.lit(" "), number)).otherwise(number)
    return Tables(spark, sf).table("events").select("event_id", convert.safe_score(text).alias("score"))


def _items(column: str) -> str:
    text = f"CASE WHEN json_valid(extend) THEN json_extract_string(extend, '$.{column}') END"
    return f"coalesce(array_to_string(list_filter(list_transform(string_split({text}, ','), lambda x: trim(x)), lambda x: x <> ''), ','), '')"


def _whole(column: str) -> str:
    text = f"CASE WHEN json_valid(extend) THEN json_extract_string(extend, '$.{column}') END"
    return (
        f"coalesce(array_to_string(list_filter(list_transform(string_split({text}, ','), lambda x: trim(x)), "
        f"lambda x: regexp_full_match(x, '[+-]?[0-9]+')), ','), '')"
    )


BRANDS_SQL = f"{_items('show_brands')} AS show_brands, {_items('hide_brands')} AS hide_brands"
STRATEGIES_SQL = f"{_whole('show_strategy')} AS show_strategies, {_whole('hide_strategy')} AS hide_strategies"
PAYMENT_SQL = """CASE WHEN json_valid(payment_info) AND payment_info <> '' THEN (id % 3) || ',' || (id % 19 + 3) ELSE '' END AS payment_brands,
  CASE WHEN json_valid(payment_info) AND payment_info <> '' AND id % 3 = 0 THEN 'p' || (id % 6)
       WHEN vip_type = '' THEN 'free' ELSE vip_type END AS vip_type"""


@query("b13_brand_lists", with_views(V_DOC, V_MEDIA, select=f"SELECT id, {BRANDS_SQL} FROM v_media"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    parsed = Tables(spark, sf).media.select("id", json_fields.parse_extend(F.col("extend")).alias("ext"))
    return parsed.select("id", json_fields.brand_lists(F.col("ext")).alias("b")).select("id", "b.*")


@query("b14_strategy_lists", with_views(V_DOC, V_MEDIA, select=f"SELECT id, {STRATEGIES_SQL} FROM v_media"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    parsed = Tables(spark, sf).media.select("id", json_fields.parse_extend(F.col("extend")).alias("ext"))
    return parsed.select("id", json_fields.strategy_lists(F.col("ext")).alias("s")).select("id", "s.*")


@query("b15_payment_fields", with_views(V_DOC, V_MEDIA, select=f"SELECT id, {PAYMENT_SQL} FROM v_media"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    parsed = Tables(spark, sf).media.select("id", "vip_type", json_fields.parse_payment(F.col("payment_info")).alias("pay"))
    fields = json_fields.payment_fields(F.col("pay"), F.col("vip_type"))
    return parsed.select("id", fields.alias("p")).select("id", "p.*")


@query(
    "b16_split_list",
    """SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 0 ELSE len(string_split(replace(p_name, ' ', ','), ',')) END::BIGINT AS n,
              CASE WHEN p_partkey % 4 = 0 THEN '' ELSE replace(p_name, ' ', ', ') END AS items FROM part""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("p_partkey") % 4 == 0, "").otherwise(F.regexp_replace("p_name", " ", ", "))
    return Tables(spark, sf).table("part").select("p_partkey", json_fields.split_list(text).alias("items")).select(
        "p_partkey", F.size("items").alias("n"), "items"
    )


@query(
    "b17_language_disable",
    """SELECT l_orderkey, l_partkey, l_suppkey,
              CAST(l_suppkey <> 0 AND l_suppkey <> l_partkey AS BIGINT) AS language_disable FROM lineitem""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    flag = convert.language_disable(F.col("l_suppkey"), F.col("l_partkey"))
    return Tables(spark, sf).line.select("l_orderkey", "l_partkey", "l_suppkey", flag.alias("language_disable"))


@query(
    "b18_int_or_zero",
    """SELECT p_partkey, CASE WHEN p_partkey % 6 IN (2, 4) THEN CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS BIGINT) ELSE 0 END AS original_id
       FROM part""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    number = brand_number().cast("string")
    text = F.when(F.col("p_partkey") % 6 == 0, F.concat(F.lit("\t"), number)).when(F.col("p_partkey") % 2 == 0, number)
    text = text.otherwise(F.col("p_name"))
    return Tables(spark, sf).table("part").select("p_partkey", convert.int_or_zero(text).alias("original_id"))


@query(
    "b19_effective_times",
    with_views(
        V_DOC,
        select="""SELECT id, greatest(create_time, 0) AS create_time, greatest(update_time, coalesce(newest, 0)) AS update_time
                  FROM v_doc LEFT JOIN (SELECT l_orderkey, CAST(epoch(max(l_shipdate)) AS BIGINT) AS newest FROM lineitem
                                        WHERE l_returnflag <> 'R' GROUP BY 1) ON id = l_orderkey""",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    newest = t.child.filter("disable = 0").groupBy("id").agg(F.max("child_time").alias("newest"))
    return t.doc.join(newest, "id", "left").select(
        "id",
        convert.effective_create(F.col("create_time")).alias("create_time"),
        convert.effective_update(F.col("update_time"), F.col("newest")).alias("update_time"),
    )


MAPPING = {"id": "long", "size": "byte", "price": "float", "number": "short", "name": "keyword"}


@query(
    "b20_conform_to_mapping",
    """SELECT p_partkey AS id, CASE WHEN p_size * 5 > 127 THEN NULL ELSE p_size * 5 END::BIGINT AS size, p_retailprice AS price,
              CASE WHEN p_partkey % 10 = 0 OR p_partkey * 20 > 32767 THEN NULL ELSE p_partkey * 20 END AS number, p_name AS name, p_type AS kind,
              CASE WHEN p_size * 5 > 127 THEN 'size' WHEN p_partkey % 10 = 0 OR p_partkey * 20 > 32767 THEN 'number' END AS reject_reason
       FROM part""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = Tables(spark, sf).table("part").select(
        F.col("p_partkey").cast("string").alias("id"),
        (F.col("p_size") * 5).alias("size"),
        F.col("p_retailprice").alias("price"),
        F.when(F.col("p_partkey") % 10 == 0, "ten").otherwise((F.col("p_partkey") * 20).cast("string")).alias("number"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("kind"),
    )
    # the float is printed with the two digits it had
    return conform_to_mapping(rows, MAPPING).withColumn("price", F.round(F.col("price").cast("double"), 2))


@query(
    "b21_multi_format_date",
    """SELECT o_orderkey, CASE o_orderkey % 14
                WHEN 3 THEN CAST(epoch(date_trunc('month', o_orderdate)) AS BIGINT) WHEN 4 THEN CAST(epoch(date_trunc('year', o_orderdate)) AS BIGINT)
                WHEN 6 THEN CAST(epoch(date_trunc('month', o_orderdate)) AS BIGINT) WHEN 8 THEN NULL WHEN 11 THEN CAST(epoch(o_orderdate) AS BIGINT) - 8 * 3600 WHEN 12 THEN 0
                WHEN 13 THEN NULL ELSE CAST(epoch(o_orderdate) AS BIGINT) END AS seconds FROM orders""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    case, day = F.col("o_orderkey") % 14, F.col("o_orderdate")
    text = (
        F.when(case == 0, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(case == 1, F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .when(case == 2, F.date_format(day, "yyyy-MM-dd"))
        .when(case == 3, F.date_format(day, "yyyy-MM"))
        .when(case == 4, F.date_format(day, "yyyy"))
        .when(case == 5, F.date_format(day, "yyyy/MM/dd"))
        .when(case == 6, F.date_format(day, "yyyy/MM"))
        .when(case == 7, (F.unix_timestamp(day.cast("timestamp")) * 1000).cast("string"))
        .when(case == 9, F.date_format(day, "yyyy-MM-dd'T'HH"))
        .when(case == 10, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss.123456'Z'"))
        .when(case == 11, F.date_format(day, "yyyy-MM-dd'T'HH:mm'+0800'"))
        .when(case == 12, F.lit("999"))
        .when(case == 13, F.lit("2023-02-30"))
        .otherwise("31.12.1999")
    )
    parsed = convert.multi_format_date(text)
    return Tables(spark, sf).table("orders").select("o_orderkey", F.unix_timestamp(parsed).alias("seconds"))


@query(
    "b22_parse_index_name",
    """SELECT event_id, CASE WHEN event_id % 6 = 0 THEN NULL ELSE 'app' || substr('abc', CAST(user_id % 3 AS INTEGER) + 1, 1) || '_' || event_type END AS base,
              CASE WHEN event_id % 6 = 0 THEN NULL WHEN event_id % 5 = 0 THEN strftime(ts, '%Y%m') ELSE strftime(ts, '%Y%m%d%H%M%S') END AS stamp,
              CASE WHEN event_id % 6 = 0 THEN NULL ELSE CAST(event_id % 4 = 0 AS BIGINT) END AS is_dev,
              CASE WHEN event_id % 6 = 0 THEN NULL ELSE 'app' || substr('abc', CAST(user_id % 3 AS INTEGER) + 1, 1) || '_' || event_type || '_' END AS prefix
       FROM events""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("event_id")
    base = F.concat(F.lit("app"), F.substring(F.lit("abc"), (F.col("user_id") % 3 + 1).cast("int"), F.lit(1)), F.lit("_"), "event_type")
    stamp = F.when(key % 5 == 0, F.date_format("ts", "yyyyMM")).otherwise(F.date_format("ts", "yyyyMMddHHmmss"))
    name = F.when(key % 6 == 0, base).otherwise(
        F.concat(base, stamp, F.when(key % 4 == 0, "_dev").otherwise(""))
    )
    parsed = Tables(spark, sf).table("events").select("event_id", name.alias("name"))
    return parsed.select("event_id", naming.parse_index_name(F.col("name")).alias("p")).select("event_id", "p.*")


@query(
    "b23_action_segments",
    """SELECT event_id, CASE WHEN event_id % 4 < 2 THEN 'app' END AS app, CASE WHEN event_id % 4 < 2 THEN event_type END AS entity,
              CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'delete' END AS op FROM events""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    case = F.col("event_id") % 4
    action = (
        F.when(case == 0, F.concat(F.lit("app_"), "event_type")).when(case == 1, F.concat(F.lit("app_"), "event_type", F.lit("_delete")))
        .when(case == 2, F.col("event_type")).otherwise(F.concat(F.lit("app_"), "event_type", F.lit("_delete_now")))
    )
    rows = Tables(spark, sf).table("events").select("event_id", naming.action_segments(action).alias("a"))
    return rows.select("event_id", "a.*")


@query(
    "b24_doc_id",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'app_mtopic_' WHEN 'O' THEN 'app_vtopic_' ELSE 'app_topic_' END || o_orderkey AS doc_id
       FROM orders""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    status = F.col("o_orderstatus")
    kind = F.when(status == "P", "media").when(status == "O", "video").otherwise("page")
    name = naming.doc_id(F.lit("app"), F.lit("topic"), F.col("o_orderkey"), kind)
    return Tables(spark, sf).table("orders").select("o_orderkey", name.alias("doc_id"))


@query(
    "b25_nested_override",
    """SELECT event_id, '{"index":{"shards":' || (event_id % 8) || ',"sort":{"field":"version_id","order":"asc"}},"user":' || user_id || '}' AS settings
       FROM events""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    settings = F.struct(
        F.struct(
            F.lit(3).cast("long").alias("shards"),
            F.struct(F.lit("update_time").alias("field"), F.lit("desc").alias("order")).alias("sort"),
        ).alias("index"),
        F.col("user_id").alias("user"),
    )
    changed = convert.nested_override(
        settings,
        {"index.shards": F.col("event_id") % 8, "index.sort.field": F.lit("version_id"), "index.sort.order": F.lit("asc")},
    )
    return Tables(spark, sf).table("events").select("event_id", F.to_json(changed).alias("settings"))
