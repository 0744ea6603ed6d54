"""Queries over change-data capture, state, queues and jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docweave.operators import changes as cdc
from docweave.operators.jobs import explode_jobs, last_jobs, next_jobs, parse_jobs, queue_depth
from docweave.operators.dispatch import requests_of, state_of
from docweave.operators.rules import Rule, apply_rules
from docweave.operators.strategy import register_strategy, strategy
from docweave.plans.consume import Route, consume_jobs, taken_ids
from docweave.plans.fixtures import Tables, V_CHANGE, V_DOC
from docweave.plans.registry import query, with_views
from docweave.session import fresh_dir

VALUE = ["user_id", "event_type", "value"]
MASTER = "cache"
QUEUE_LIMIT = 2000

V_LAST = """v_last AS (SELECT * FROM v_change QUALIFY row_number() OVER (PARTITION BY base, key ORDER BY pos DESC) = 1)"""
_JSON = """'{"user_id":' || user_id || ',"event_type":"' || event_type || '","value":' || value || '}'"""
_TAG = "base || CASE WHEN action = 'delete' THEN '_delete' ELSE '' END"
V_BATCH = f"""v_batch AS (SELECT *, (row_number() OVER (ORDER BY file, pos) - 1) // 1000 AS batch_no, {_TAG} AS tag FROM v_change)"""
V_COMPACT = """v_compact AS (SELECT batch_no, 'jobs' AS queue, tag, string_agg(key, ',' ORDER BY file, pos) AS ids, count(*) AS n_ids,
  max(event_time) AS score FROM v_batch GROUP BY 1, 2, 3)"""
V_QUEUE = """v_queue AS (SELECT queue, tag || ':' || ids AS member, CAST(arg_max(score, batch_no) AS DOUBLE) AS score
  FROM v_compact GROUP BY 1, 2)"""


def _tag(prefix: str = "", mark_delete: bool = True) -> Column:
    return cdc.change_tag(F.col("db"), F.col("tbl"), F.col("action"), F.col("key"), prefix, mark_delete)


def compacted(t: Tables) -> DataFrame:
    """All changes compacted per flush batch."""
    queue_tag = strategy().queue_tag(F.col("db"), F.col("tbl"), F.col("action"))
    batched = cdc.flush_batches(t.change.select("file", "pos", "db", "tbl", "action", "key", "event_time"))
    return cdc.compact_ids(batched, F.lit("jobs"), queue_tag, F.col("key"), F.col("event_time"))


@query("d4_compact_ids", with_views(V_CHANGE, V_BATCH, V_COMPACT, select="SELECT * FROM v_compact"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return compacted(Tables(spark, sf))


@query(
    "d5_queue_depth",
    with_views(V_CHANGE, select=f"SELECT base AS queue, count(*) AS depth, CAST(count(*) >= {QUEUE_LIMIT} AS BIGINT) AS is_full FROM v_change GROUP BY 1"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    members = Tables(spark, sf).change.select(cdc.tag_base(F.col("db"), F.col("tbl")).alias("queue"))
    return queue_depth(members, "queue", QUEUE_LIMIT)


@query("e1_latest_per_key", with_views(V_CHANGE, V_LAST, select="SELECT base, key, file, pos, action, value FROM v_last"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = Tables(spark, sf).change.select(
        cdc.tag_base(F.col("db"), F.col("tbl")).alias("base"), "key", "file", "pos", "action", "value"
    )
    return cdc.latest_per_key(rows, ["base", "key"])


@query(
    "e2_pair_images",
    """SELECT n.event_id // 40 AS event, n.event_id % 40 // 2 AS pair_no, o.value AS old_value, n.value AS new_value,
              o.event_type AS old_type, n.event_type AS new_type
       FROM events n LEFT JOIN events o ON o.event_id = n.event_id - 1 WHERE n.event_id % 2 = 1""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Every two rows of the feed are the old and the new image of one update; forty rows are one event."""
    rows = Tables(spark, sf).table("events").select(
        F.expr("event_id div 40").alias("event"), (F.col("event_id") % 40).alias("row_idx"), "value", "event_type"
    )
    pairs = cdc.pair_images(rows, ["event"], "row_idx", ["value", "event_type"])
    return pairs.select(
        "event", "pair_no", F.col("old.value").alias("old_value"), F.col("new.value").alias("new_value"),
        F.col("old.event_type").alias("old_type"), F.col("new.event_type").alias("new_type"),
    )


@query("f1_next_jobs", with_views(V_CHANGE, V_BATCH, V_COMPACT, V_QUEUE, select="SELECT member, score FROM v_queue ORDER BY score, member LIMIT 20"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return next_jobs(cdc.compact_jobs(compacted(Tables(spark, sf))).select("member", "score"), 20)


@query(
    "f2_last_jobs",
    with_views(V_CHANGE, V_BATCH, V_COMPACT, V_QUEUE, select="SELECT member, score FROM v_queue ORDER BY score DESC, member DESC LIMIT 20 OFFSET 5"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return last_jobs(cdc.compact_jobs(compacted(Tables(spark, sf))).select("member", "score"), 20, offset=5)


WIDTHS = {"db_app0_media:fm_click": 3, "DB_APP1_media:FM_view": 3, "db_app2_media:fm_error": 2}


@query(
    "h1_apply_rules",
    with_views(
        V_CHANGE,
        select="""SELECT pos, lower(db || ':' || tbl) AS rule_key, action FROM v_change
  WHERE (base IN ('app0_click', 'app1_view') AND pos % 19 <> 0) OR (base = 'app2_error' AND pos % 19 = 0)""",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    short, full = F.array("key", "props"), F.array("key", F.col("value").cast("string"), "props")
    rows = Tables(spark, sf).change.withColumn("row", F.when(F.col("pos") % 19 == 0, short).otherwise(full))
    return apply_rules(rows, WIDTHS).select("pos", "rule_key", "action")


@query(
    "h3_change_key",
    """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, CAST(l_orderkey AS VARCHAR) AS single,
              CASE WHEN l_linenumber = 7 THEN '[' || l_orderkey || ']' ELSE '[' || l_orderkey || '+' || l_linenumber || ']' END AS composite
       FROM lineitem""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    number = F.when(F.col("l_linenumber") != 7, F.col("l_linenumber"))
    moved = F.when(F.col("l_partkey") % 2 == 0, F.col("l_orderkey"))
    return Tables(spark, sf).line.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        cdc.change_key([(moved, F.col("l_orderkey"))]).alias("single"),
        cdc.change_key([(F.col("l_orderkey"), None), (number, None)]).alias("composite"),
    )


@query(
    "h4_change_tag",
    with_views(
        V_CHANGE,
        select=f"""SELECT pos, CASE WHEN pos % 17 > 1 THEN {_TAG} || ':' || key END AS tag,
          CASE pos % 17 WHEN 0 THEN 'database segments' WHEN 1 THEN 'table segments' END AS reject_reason FROM v_change""",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = Tables(spark, sf).change.withColumns(
        {
            "db": F.when(F.col("pos") % 17 == 0, F.lit("db_short")).otherwise(F.col("db")),
            "tbl": F.when(F.col("pos") % 17 == 1, F.lit("plain")).otherwise(F.col("tbl")),
        }
    )
    return rows.select("pos", _tag().alias("tag"), cdc.tag_reject(F.col("db"), F.col("tbl")).alias("reject_reason"))


@query("h5_kv_state", with_views(V_CHANGE, V_LAST, select=f"SELECT 'kv_' || base || ':' || key AS key, {_JSON} AS value FROM v_last WHERE action <> 'delete'"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.kv_state(Tables(spark, sf).change, _tag("kv_", mark_delete=False), VALUE)


@query(
    "h6_hash_state",
    with_views(V_CHANGE, V_LAST, select=f"SELECT '{MASTER}' AS key, base || ':' || key AS sub_key, {_JSON} AS value FROM v_last WHERE action <> 'delete'"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.hash_state(Tables(spark, sf).change, F.lit(MASTER), _tag(mark_delete=False), VALUE)


@query("h7_append_log", with_views(V_CHANGE, select=f"SELECT file, pos, {_TAG} || ':' || key AS tag FROM v_change"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.append_log(Tables(spark, sf).change, _tag())


@query("h8_distinct_set", with_views(V_CHANGE, select=f"SELECT DISTINCT {_TAG} || ':' || key AS member FROM v_change"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.distinct_set(Tables(spark, sf).change, _tag())


@query(
    "h9_scored_set",
    with_views(
        V_CHANGE,
        select=f"""SELECT {_TAG} || ':' || key AS member,
          arg_max(CASE WHEN pos % 4 = 0 THEN CAST(event_time AS DOUBLE) WHEN pos % 4 = 1 THEN 0 ELSE value END, pos) AS score FROM v_change GROUP BY 1""",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    case = F.col("pos") % 4
    score = F.when(case == 1, F.lit("none")).when(case != 0, F.col("value").cast("string"))
    return cdc.scored_set(Tables(spark, sf).change, _tag(), score, F.col("event_time"))


@query("h10_compact_jobs", with_views(V_CHANGE, V_BATCH, V_COMPACT, V_QUEUE, select="SELECT queue, member, score FROM v_queue"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.compact_jobs(compacted(Tables(spark, sf)))


V_JOB = """v_job AS (SELECT pos, base, key, action, CASE pos % 12 WHEN 0 THEN base || key WHEN 1 THEN base || ':' || key || '@1@2' WHEN 2 THEN base || ':' || key || CASE WHEN pos % 24 = 2 THEN '@x' ELSE '@99999999999' END
    WHEN 3 THEN base || ':' WHEN 4 THEN base || ':' || key || ',' WHEN 5 THEN base || '_update:' || key WHEN 6 THEN 'app:' || key
    WHEN 7 THEN base || '_delete:' || key || ',,' || pos || '@2' ELSE base || ':' || key || ',' || pos END AS member FROM v_change)"""


def _jobs(t: Tables) -> DataFrame:
    base, key, pos = cdc.tag_base(F.col("db"), F.col("tbl")), F.col("key"), F.col("pos").cast("string")
    case = F.col("pos") % 12
    member = (
        F.when(case == 0, F.concat(base, key)).when(case == 1, F.concat(base, F.lit(":"), key, F.lit("@1@2")))
        .when(case == 2, F.concat(base, F.lit(":"), key, F.when(F.col("pos") % 24 == 2, "@x").otherwise("@99999999999"))).when(case == 3, F.concat(base, F.lit(":")))
        .when(case == 4, F.concat(base, F.lit(":"), key, F.lit(","))).when(case == 5, F.concat(base, F.lit("_update:"), key))
        .when(case == 6, F.concat(F.lit("app:"), key)).when(case == 7, F.concat(base, F.lit("_delete:"), key, F.lit(",,"), pos, F.lit("@2")))
        .otherwise(F.concat(base, F.lit(":"), key, F.lit(","), pos))
    )
    return t.change.select("pos", member.alias("member"))


@query(
    "h11_parse_jobs",
    with_views(
        V_CHANGE, V_JOB,
        select="""SELECT pos, member, CASE WHEN pos % 12 > 6 THEN split_part(base, '_', 1) END AS app,
          CASE WHEN pos % 12 > 6 THEN split_part(base, '_', 2) END AS entity,
          CASE WHEN pos % 12 = 7 THEN 'delete' WHEN pos % 12 > 7 THEN '' END AS op,
          CASE WHEN pos % 12 = 7 THEN key || ',,' || pos WHEN pos % 12 > 7 THEN key || ',' || pos END AS ids,
          CASE WHEN pos % 12 = 7 THEN 2::BIGINT WHEN pos % 12 > 7 THEN 0::BIGINT END AS retry,
          CASE pos % 12 WHEN 0 THEN 'format' WHEN 1 THEN 'retry format' WHEN 2 THEN 'retry number' WHEN 3 THEN 'ids' WHEN 4 THEN 'ids'
                        WHEN 5 THEN 'operation' WHEN 6 THEN 'action' END AS reject_reason FROM v_job""",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return parse_jobs(_jobs(Tables(spark, sf)))


@query(
    "h12_explode_jobs",
    with_views(
        V_CHANGE, V_JOB,
        select="""SELECT split_part(base, '_', 1) AS app, split_part(base, '_', 2) AS entity, CASE WHEN pos % 12 = 7 THEN 'delete' ELSE '' END AS op,
          CASE WHEN pos % 12 = 7 THEN 2::BIGINT ELSE 0::BIGINT END AS retry, CAST(unnest([key, CAST(pos AS VARCHAR)]) AS BIGINT) AS id
          FROM v_job WHERE pos % 12 > 6""",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return explode_jobs(parse_jobs(_jobs(Tables(spark, sf))))


SAVED_FILE, SAVED_POS = "log.20240102", 50


@query(
    "h13_replay_from",
    with_views(
        V_CHANGE,
        select=f"""SELECT file, pos, action FROM v_change
          WHERE file > '{SAVED_FILE}' OR (file = '{SAVED_FILE}' AND pos > {SAVED_POS})""",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The feed is stored in log order first, so the position reaches its files."""
    path = fresh_dir(spark, "feed")
    Tables(spark, sf).change.select("file", "pos", "action").repartitionByRange("file", "pos").write.parquet(path)
    return cdc.replay_from(spark.read.parquet(path), SAVED_FILE, SAVED_POS)


RULES = [
    Rule(["db_app[0-2]_media"], ["FM_click"], structure="string", key_prefix="kv_", exclude_columns=["props"], datetime_pattern="yyyyMMdd"),
    Rule(["*"], ["fm_view"], structure="hash", master_key="views", include_columns=["value", "user_id"]),
    Rule(["*"], ["fm_signup"], structure="list", master_key="jobs"),
    Rule(["*"], ["^fm_err"], structure="set", master_key="errors"),
    Rule(["*"], ["fm_purchase"], structure="sortedset", master_key="scores", score_column="value"),
    Rule(["nothing"], ["nothing"], exclude_databases=["db_app1_media"], exclude_tables=["fm_purchase"], structure="string"),
]
_NONE = "CAST(NULL AS VARCHAR)"


@query(
    "h_rule_dispatch",
    with_views(
        V_CHANGE, V_LAST,
        "seen AS (SELECT c.*, e.ts FROM v_change c JOIN events e ON c.pos = e.event_id)",
        select=f"""
  SELECT 'string' AS structure, 'kv_' || base || ':' || key AS key, {_NONE} AS sub_key,
         '{{"user_id":' || user_id || ',"event_type":"' || event_type || '","value":' || value || ',"ts":"' || strftime(ts, '%Y%m%d') || '"}}' AS value,
         CAST(NULL AS DOUBLE) AS score, {_NONE} AS file, CAST(NULL AS BIGINT) AS pos
  FROM seen WHERE event_type = 'click' QUALIFY row_number() OVER (PARTITION BY base, key ORDER BY pos DESC) = 1
  UNION ALL SELECT 'hash', 'views', base || ':' || key, '{{"user_id":' || user_id || ',"value":' || value || '}}', NULL, NULL, NULL
  FROM v_last WHERE event_type = 'view'
  UNION ALL SELECT 'list', 'jobs', NULL, base || ':' || key, NULL, file, pos FROM v_change WHERE event_type = 'signup'
  UNION ALL SELECT DISTINCT 'set', 'errors', NULL, base || '_delete:' || key, NULL::DOUBLE, NULL, NULL::BIGINT FROM v_change WHERE event_type = 'error'
  UNION ALL SELECT 'sortedset', 'scores', NULL, base || ':' || key, value, NULL, NULL FROM v_last
  WHERE event_type = 'purchase' AND db <> 'db_app1_media'""",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """All five structures in one run, each table by its rule; one table is excluded for one database."""
    t = Tables(spark, sf)
    stamped = t.table("events").select(F.col("event_id").alias("_pos"), "ts")
    changes = t.change.join(stamped, F.col("pos") == F.col("_pos"))
    changes = changes.withColumn("row", F.struct("user_id", "event_type", "value", "props", "ts"))
    return state_of(requests_of(changes, RULES))


TAKE, TAKEN_AT = 40, 1_706_400_000
APPS = [f"app{i}" for i in range(3)]
ENTITIES = ["click", "error", "purchase", "signup", "view"]
# Every document stands for one of each entity; targets of different entities lack different documents.
_GROWN = "price + 1 + length(entity)"
_HELD = "(id + length(entity)) % 5 <> 0"
V_TAKEN = f"""v_entity AS (SELECT unnest([{", ".join(f"'{e}'" for e in ENTITIES)}]) AS entity),
  v_taken AS (SELECT member, score FROM v_queue ORDER BY score, member LIMIT {TAKE}),
  v_listed AS (SELECT member, score, split_part(member, ':', 1) AS tag, CAST(unnest(string_split(split_part(member, ':', 2), ',')) AS BIGINT) AS id FROM v_taken),
  v_ids AS (SELECT id, tag, split_part(tag, '_', 1) AS app, split_part(tag, '_', 2) AS entity, split_part(tag, '_', 3) = 'delete' AS gone, id % 11 = 0 AS failed FROM v_listed
            QUALIFY row_number() OVER (PARTITION BY split_part(tag, '_', 1), split_part(tag, '_', 2), id ORDER BY score DESC, member DESC) = 1),
  v_app AS (SELECT unnest([{", ".join(f"'{a}'" for a in APPS)}]) AS app),
  v_rows AS (SELECT app, entity, id, {_GROWN} AS price FROM v_doc JOIN v_ids USING (id) WHERE NOT gone AND NOT failed),
  v_target AS (SELECT app, entity, id, price FROM v_doc, v_entity, v_app WHERE {_HELD})"""
_JOBS = (V_CHANGE, V_BATCH, V_COMPACT, V_QUEUE, V_DOC, V_TAKEN)


def _consumed(spark: SparkSession, sf: str):
    t = Tables(spark, sf)
    queue = cdc.compact_jobs(compacted(t)).select("member", "score")
    each = F.explode(F.array(*[F.lit(e) for e in ENTITIES])).alias("entity")
    rows = t.doc.select("id", "price", each)
    routes = []
    for app in APPS:
        named = rows.withColumn("tag", F.concat(F.lit(app + "_"), "entity"))
        source = named.select("tag", "id", F.expr(_GROWN).alias("price"))
        target = named.filter(_HELD).select("tag", "id", "price")
        routes.append(Route([f"{app}_{e}" for e in ENTITIES], source, target, tag="tag"))
    taken, _ = taken_ids(next_jobs(queue, TAKE))
    ledger = spark.createDataFrame([], "tag string, id bigint, times int, expires_at bigint")
    return consume_jobs(queue, TAKE, routes, ledger=ledger, now=TAKEN_AT, failed=taken.filter("id % 11 = 0"))


@query(
    "h12_consume_jobs",
    with_views(
        *_JOBS,
        select="""SELECT app || '_' || entity AS tag, id, CASE WHEN r.price IS NULL THEN d.price ELSE r.price END AS price
                  FROM v_target d FULL JOIN v_rows r USING (app, entity, id)
                  WHERE (app, entity, id) NOT IN (SELECT (app, entity, id) FROM v_ids WHERE gone AND NOT failed)""",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The targets of all applications and entities after the next jobs."""
    targets = _consumed(spark, sf).targets
    return targets[0].unionByName(targets[1]).unionByName(targets[2])


@query(
    "h12_consume_queue",
    with_views(
        *_JOBS,
        select="""SELECT member, score FROM v_queue WHERE member NOT IN (SELECT member FROM v_taken)
                  UNION ALL SELECT tag || ':' || id || '@1', 0 FROM v_ids WHERE failed""",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """What is left in the queue, with the failed ids queued again."""
    return _consumed(spark, sf).queue


@query("h13_last_position", with_views(V_CHANGE, select="SELECT max(file) AS file, max(pos) AS pos FROM v_change"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.last_position(Tables(spark, sf).change)


@query(
    "h14_bootstrap_and_tail",
    with_views(
        V_DOC, V_CHANGE,
        select="""
  SELECT coalesce(d.id, c.user_id) AS id, CASE WHEN c.pos IS NULL THEN d.price ELSE c.value END AS value
  FROM (SELECT id, price FROM v_doc) d FULL JOIN
       (SELECT * FROM v_change QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY pos DESC) = 1) c ON d.id = c.user_id
  WHERE c.pos IS NULL OR c.action <> 'delete'""",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    snapshot = t.doc.select("id", F.col("price").alias("value"))
    tail = t.change.select(F.col("user_id").alias("id"), "value", "action", "file", "pos")
    return cdc.bootstrap_and_tail(snapshot, tail, ["id"])


def _entity_first(db: Column, tbl: Column, action: Column, key: Column) -> Column:
    """``entity/app/key``."""
    base = F.split(cdc.tag_base(db, tbl), "_")
    return F.concat_ws("/", F.get(base, F.lit(1)), F.get(base, F.lit(0)), key)


register_strategy("entity_first", _entity_first, lambda db, tbl, action: cdc.tag_base(db, tbl))


@query(
    "m1_registered_strategy",
    with_views(
        V_CHANGE,
        select=f"""SELECT pos, {_TAG} || ':' || key AS segmented, split_part(base, '_', 2) || '/' || split_part(base, '_', 1) || '/' || key AS entity_first
          FROM v_change""",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    arguments = [F.col(c) for c in ("db", "tbl", "action", "key")]
    return Tables(spark, sf).change.select(
        "pos", *[strategy(name).tag(*arguments).alias(name) for name in ("segmented", "entity_first")]
    )
