"""Queries over upserts, snapshots, retries and the dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from docweave.operators import dictionary, merge, publish
from docweave.operators.logs import read_monthly, write_monthly
from docweave.operators.retry import fold_outcomes, retry_ledger
from docweave.operators.shards import ShardedTarget
from docweave.plans.fixtures import Tables, V_CHANGE, V_DOC
from docweave.plans.registry import query, with_views
from docweave.session import fresh_dir
from docweave.sources.scans import incremental_scan

SNAPSHOT = ["id", "disable", "update_time", "price", "name"]
_SNAPSHOT = "id, CAST(disable AS BIGINT) AS disable, update_time, price, name"

# Every second document changes and new ones are added behind the last key.
V_UPDATE = """v_update AS (
  SELECT id, 0 AS disable, update_time + 60 AS update_time, CASE WHEN id % 4 = 0 THEN NULL ELSE price * 2 END AS price FROM v_doc WHERE id % 2 = 0
  UNION ALL SELECT id + 10000000, CASE WHEN id % 3 = 0 THEN 1 ELSE 0 END, update_time, price FROM v_doc WHERE id % 5 = 0)"""


def _target(t: Tables) -> DataFrame:
    return t.doc.select(*SNAPSHOT)


def _updates(t: Tables) -> DataFrame:
    doc = t.doc
    changed = doc.filter("id % 2 = 0").select(
        "id",
        F.lit(0).alias("disable"),
        (F.col("update_time") + 60).alias("update_time"),
        F.when(F.col("id") % 4 != 0, F.col("price") * 2).alias("price"),
    )
    added = doc.filter("id % 5 = 0").select(
        (F.col("id") + 10_000_000).alias("id"), F.when(F.col("id") % 3 == 0, 1).otherwise(0).alias("disable"), "update_time", "price"
    )
    return changed.unionByName(added)


V_MERGED = """v_merged AS (
  SELECT coalesce(d.id, u.id) AS id, CASE WHEN u.id IS NULL THEN d.disable ELSE u.disable END AS disable,
         CASE WHEN u.id IS NULL THEN d.update_time ELSE u.update_time END AS update_time,
         CASE WHEN u.id IS NULL THEN d.price ELSE u.price END AS price, d.name, u.id IS NOT NULL AS touched
  FROM v_doc d FULL JOIN v_update u ON d.id = u.id)"""


@query("i1_upsert_merge", with_views(V_DOC, V_UPDATE, V_MERGED, select=f"SELECT {_SNAPSHOT} FROM v_merged"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return merge.upsert_merge(_target(t), _updates(t), "id")


@query(
    "i2_route_disabled",
    with_views(V_DOC, select="SELECT CASE WHEN disable = 0 THEN 'upsert' ELSE 'delete' END AS action, id FROM v_doc"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    upserts, deletes = merge.route_disabled(_target(Tables(spark, sf)), False, "id")
    named = upserts.select(F.lit("upsert").alias("action"), "id")
    return named.unionByName(deletes.select(F.lit("delete").alias("action"), "id"))


@query("i3_apply_batch", with_views(V_DOC, V_UPDATE, V_MERGED, select=f"SELECT {_SNAPSHOT} FROM v_merged WHERE NOT (touched AND disable <> 0)"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return merge.apply_batch(_target(t), _updates(t), "id")


@query("i3_apply_batch_sharded", with_views(V_DOC, V_UPDATE, V_MERGED, select=f"SELECT {_SNAPSHOT} FROM v_merged WHERE NOT (touched AND disable <> 0)"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The target lies in shards; two batches rewrite the shards that they touch."""
    t = Tables(spark, sf)
    rows = _target(t)
    target = ShardedTarget(spark, fresh_dir(spark, "sharded"), rows.schema, ["id"], shards=16, order=["id"]).create(rows)
    updates = _updates(t)
    for part in ("id < 10000000", "id >= 10000000"):
        target.apply(updates.filter(part), lambda old, new: merge.apply_batch(old, new, "id"))
    return target.read()


@query(
    "i4_update_by_ids",
    "SELECT p_partkey, CASE WHEN p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45) THEN 'hot' ELSE p_type END AS p_type FROM part",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    ids = t.line.filter("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return merge.update_by_ids(t.table("part").select("p_partkey", "p_type"), ids, "p_partkey", "p_type", F.lit("hot"))


@query(
    "i5_update_by_map",
    """SELECT p_partkey, CASE WHEN s_suppkey IS NULL THEN p_brand ELSE s_name END AS p_brand, p_size::BIGINT AS p_size
       FROM part LEFT JOIN supplier ON p_partkey = s_suppkey * 3""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    values = t.table("supplier").select((F.col("s_suppkey") * 3).alias("p_partkey"), F.col("s_name").alias("p_brand"))
    return merge.update_by_map(t.table("part").select("p_partkey", "p_brand", "p_size"), values, "p_partkey")


@query(
    "i5_dispatch_brands",
    """SELECT p_partkey, p_name, CASE WHEN s_suppkey IS NULL THEN 'none' WHEN s_suppkey % 2 = 1 THEN '12' ELSE '' END AS inject_brands
       FROM part LEFT JOIN supplier ON p_partkey = s_suppkey""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    dispatch = t.table("supplier").select(F.col("s_suppkey").alias("p_partkey"), (F.col("s_suppkey") % 2).alias("enable"))
    target = t.table("part").select("p_partkey", "p_name", F.array(F.lit("none")).alias("inject_brands"))
    return merge.update_by_map(target, merge.dispatch_brands(dispatch, "p_partkey", "enable", "12"), "p_partkey")


@query(
    "m2_update_expr",
    """SELECT p_partkey, CASE WHEN p_size > 25 THEN p_retailprice * 2 ELSE p_retailprice END AS p_retailprice,
              CASE WHEN p_size > 25 THEN p_size - 25 ELSE p_size END::BIGINT AS p_size FROM part""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    part = Tables(spark, sf).table("part").select("p_partkey", "p_retailprice", "p_size")
    return merge.update_expr(part, F.col("p_size") > 25, {"p_retailprice": F.col("p_retailprice") * 2, "p_size": F.col("p_size") - 25})


STAMPS = ("20240101000000", "20240101000500")
CATCH_UP_NOW, CATCH_UP_PERIOD = 1_000_000_000, 20_000_000


@query(
    "i6_publish_snapshot",
    with_views(
        V_DOC, V_UPDATE,
        f"v_recent AS (SELECT * FROM v_update WHERE update_time > {CATCH_UP_NOW - CATCH_UP_PERIOD})",
        V_MERGED.replace("JOIN v_update u", "JOIN v_recent u"),
        select=f"SELECT {_SNAPSHOT} FROM v_merged WHERE NOT (touched AND disable <> 0)",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    root = fresh_dir(spark, "published")
    recent = incremental_scan(_updates(t), "update_time", CATCH_UP_NOW, CATCH_UP_PERIOD)
    publish.publish_with_catch_up(_target(t), recent, root, "app_media", STAMPS, "id")
    return publish.resolve_alias(spark, root, "app_media")


@query(
    "i7_retire_snapshots",
    "SELECT stamp, s_suppkey, s_name FROM supplier, (SELECT unnest(['20240101000100', '20240101000200']) AS stamp)",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Three versions of the suppliers are published; the rows of the two that stay."""
    root = fresh_dir(spark, "retired")
    suppliers = Tables(spark, sf).table("supplier").select("s_suppkey", "s_name")
    stamps = ("20240101000000", "20240101000100", "20240101000200")
    for stamp in stamps:
        publish.publish_snapshot(suppliers, root, "app_actor", stamp)
    publish.retire_snapshots(spark, root, "app_actor")
    kept = [r["stamp"] for r in publish.read_catalog(spark, root).filter("status = 'live'").select("stamp").collect()]
    combined = None
    for stamp in sorted(kept):
        part = spark.read.parquet(f"{root}/app_actor/{stamp}").select(F.lit(stamp).alias("stamp"), "s_suppkey", "s_name")
        combined = part if combined is None else combined.unionByName(part)
    return combined


@query(
    "e4_retention_rank",
    with_views(
        """v_version AS (SELECT 'app_' || event_type AS alias, strftime(ts, '%Y%m%d%H%M%S') || lpad(CAST(event_id AS VARCHAR), 12, '0') AS stamp,
             event_id % 50 = 0 AS pointed FROM events)""",
        """v_current AS (SELECT alias, max(stamp) AS cur FROM v_version WHERE pointed GROUP BY 1)""",
        """v_spare AS (SELECT alias, max(stamp) AS spare FROM v_version JOIN v_current USING (alias) WHERE stamp <> cur GROUP BY 1)""",
        select="""SELECT alias, stamp, CASE WHEN stamp = cur THEN 'current' WHEN stamp = spare THEN 'spare' ELSE 'delete' END AS verdict
          FROM v_version JOIN v_current USING (alias) LEFT JOIN v_spare USING (alias)""",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    stamp = F.concat(F.date_format("ts", "yyyyMMddHHmmss"), F.lpad(F.col("event_id").cast("string"), 12, "0"))
    versions = Tables(spark, sf).table("events").select(
        F.concat(F.lit("app_"), "event_type").alias("alias"), stamp.alias("stamp"), (F.col("event_id") % 50 == 0).alias("pointed")
    )
    return publish.retention_rank(versions).select("alias", "stamp", "verdict")


@query(
    "i8_write_monthly",
    "SELECT event_id, user_id, strftime(ts + INTERVAL 8 HOUR, '%Y%m') AS month FROM events",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_dir(spark, "monthly")
    events = Tables(spark, sf).table("events").select(F.col("event_id").alias("id"), "user_id", "ts")
    write_monthly(events, path, "first", "ts")
    write_monthly(events.filter("id % 3 = 0"), path, "second", "ts")
    write_monthly(events, path, "first", "ts")  # the same batch again, and rows of one in the other
    return read_monthly(spark, path).select(F.col("id").alias("event_id"), "user_id", "month")


V_OUTCOME = """v_ledger AS (SELECT base AS tag, key AS id, 1 + count(*) % 3 AS times, max(event_time) + 3600 AS expires_at
    FROM v_change WHERE pos % 2 = 0 GROUP BY 1, 2),
  v_outcome AS (SELECT base AS tag, key AS id, bool_or(value > 40) AS failed FROM v_change WHERE pos % 2 = 1 GROUP BY 1, 2)"""
RETRY_NOW = 1_706_400_000


def _retry_inputs(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows = t.change.withColumn("tag", F.concat(F.split("db", "_")[1], F.lit("_"), "event_type")).withColumn("id", F.col("key"))
    ledger = rows.filter("pos % 2 = 0").groupBy("tag", "id").agg(
        (F.count(F.lit(1)) % 3 + 1).cast("int").alias("times"), (F.max("event_time") + 3600).alias("expires_at")
    )
    outcomes = rows.filter("pos % 2 = 1").select("tag", "id", (F.col("value") > 40).alias("failed"))
    return outcomes, ledger


V_FOLDED = f"""v_folded AS (
  SELECT coalesce(o.tag, l.tag) AS tag, coalesce(o.id, l.id) AS id,
         coalesce(times, 0) + CASE WHEN failed THEN 1 ELSE 0 END AS times,
         CASE WHEN failed THEN {RETRY_NOW} + 3600 ELSE expires_at END AS expires_at,
         CASE WHEN failed IS NULL THEN 'waiting' WHEN NOT failed THEN 'done' WHEN coalesce(times, 0) >= 3 THEN 'exhausted' ELSE 'retry' END AS fate
  FROM v_outcome o FULL JOIN (SELECT * FROM v_ledger WHERE expires_at > {RETRY_NOW}) l ON o.tag = l.tag AND o.id = l.id)"""


@query("i10_retry_ledger", with_views(V_CHANGE, V_OUTCOME, V_FOLDED, select="SELECT * FROM v_folded"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    outcomes, ledger = _retry_inputs(Tables(spark, sf))
    return fold_outcomes(outcomes, ledger, RETRY_NOW)


@query(
    "i10_requeued_members",
    with_views(V_CHANGE, V_OUTCOME, V_FOLDED, select="SELECT tag || ':' || id || '@' || times AS member, CAST(0 AS DOUBLE) AS score FROM v_folded WHERE fate = 'retry'"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    outcomes, ledger = _retry_inputs(Tables(spark, sf))
    return retry_ledger(outcomes, ledger, RETRY_NOW).requeue


@query("d6_bulk_outcome_summary", "SELECT event_type AS action, count(*) FILTER (WHERE value <= 40) AS n_success, count(*) FILTER (WHERE value > 40) AS n_failed FROM events GROUP BY 1")
def _(spark: SparkSession, sf: str) -> DataFrame:
    outcomes = Tables(spark, sf).table("events").select(F.col("event_type").alias("action"), (F.col("value") > 40).alias("failed"))
    return merge.bulk_outcome_summary(outcomes, "action", "failed")


@query(
    "g3_succeeded_ids",
    "SELECT DISTINCT event_type, user_id FROM events EXCEPT SELECT event_type, user_id FROM events WHERE value > 100",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    events = Tables(spark, sf).table("events")
    return merge.succeeded_ids(events, events.filter("value > 100"), ["event_type", "user_id"])


@query(
    "g4_app_view",
    """SELECT 'media' AS entity, o_orderkey AS id, o_orderpriority AS name, o_totalprice AS price, NULL AS brand FROM orders
       UNION ALL SELECT 'part', p_partkey, p_name, NULL, p_brand FROM part""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    media = t.doc.select("id", "name", "price")
    part = t.table("part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"))
    return merge.app_view({"media": media, "part": part})


# The update time of a word is taken from its key, so that the incremental form has something to select.
V_WORD = """v_word AS (SELECT word, update_time, source FROM (
    SELECT p_name AS word, 0 AS source, p_partkey AS k, p_partkey * 60 AS update_time FROM part
    UNION ALL SELECT s_name, 1, s_suppkey, s_suppkey * 60 FROM supplier
    UNION ALL SELECT CASE WHEN c_custkey % 6 = 0 THEN '' WHEN c_custkey % 6 = 1 THEN replace(c_name, 'Customer', 'Supplier') ELSE c_mktsegment END,
              2, c_custkey, c_custkey * 60 FROM customer) WHERE word <> ''
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY source, k) = 1)"""


def words(t: Tables) -> DataFrame:
    """Dictionary of part, supplier and customer words."""
    part = t.table("part").withColumn("at", F.col("p_partkey") * 60)
    supplier = t.table("supplier").withColumn("at", F.col("s_suppkey") * 60)
    case = F.col("c_custkey") % 6
    word = F.when(case == 0, "").when(case == 1, F.regexp_replace("c_name", "Customer", "Supplier")).otherwise(F.col("c_mktsegment"))
    customer = t.table("customer").withColumn("word", word).withColumn("at", F.col("c_custkey") * 60)
    return dictionary.dictionary_union(
        [(part, "p_name", "at", "p_partkey"), (supplier, "s_name", "at", "s_suppkey"), (customer, "word", "at", "c_custkey")]
    )


@query("g1_dictionary_union", with_views(V_WORD, select="SELECT word, update_time, source::BIGINT AS source FROM v_word"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return words(Tables(spark, sf))


@query("g5_incremental_dictionary", with_views(V_WORD, select="SELECT word, update_time, source::BIGINT AS source FROM v_word WHERE update_time > 3600 - 1800"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return dictionary.incremental_dictionary(words(Tables(spark, sf)), 3600, 1800)


@query(
    "g1_dictionary_merge",
    with_views(
        V_WORD,
        select="""SELECT word, CASE WHEN length(word) % 2 = 0 THEN 1::BIGINT ELSE update_time END AS update_time,
                         CASE WHEN length(word) % 2 = 0 THEN -1::BIGINT ELSE source::BIGINT END AS source FROM v_word WHERE length(word) % 5 <> 0""",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Every second word is there already and keeps its row; some are removed afterwards."""
    found = words(Tables(spark, sf))
    known = found.filter(F.length("word") % 2 == 0)
    existing = known.select("word", F.lit(1).cast("long").alias("update_time"), F.lit(-1).alias("source"))
    merged = dictionary.merge_dictionary(existing, found)
    return dictionary.remove_words(merged, found.filter(F.length("word") % 5 == 0))


@query("i9_export_dictionary", with_views(V_WORD, select="SELECT word FROM v_word"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_dir(spark, "dictionary")
    dictionary.export_dictionary(words(Tables(spark, sf)), path)
    return dictionary.read_dictionary(spark, path)
