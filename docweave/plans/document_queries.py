"""Queries over joins, document building, ranks and prefix postings."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from docweave.operators import enrich
from docweave.operators.asof import newest_position, position_as_of
from docweave.operators.dictionary import dictionary_union
from docweave.operators.merge import without
from docweave.operators.numbering import assign_versions, index_sort, rank_in_group, running_offsets, shard_of
from docweave.operators.postings import (
    ALIAS_WEIGHT, NAME_WEIGHT, SPELLED_WEIGHT, prefix_index, prefix_postings, weighted_postings,
)
from docweave.operators.propagate import add_deltas, count_deltas, delta_of, keys_in, union_of
from docweave.operators.rules import Rule, effective_rules, require_rules, rule_match
from docweave.operators.rule_table import effective_by_table, match_rules, rules_frame
from docweave.operators.segment import segment
from docweave.plans.actor import build_actor_document
from docweave.plans.column_queries import BRANDS_SQL, PAYMENT_SQL, STRATEGIES_SQL
from docweave.plans.fixtures import (
    Tables,
    V_AREA,
    V_CATEGORY,
    V_CHANGE,
    V_CHANNEL,
    V_CHILD,
    V_DIRECTOR,
    V_DOC,
    V_MEDIA,
    V_PERSON,
    V_TAG,
)
from docweave.plans.media import MediaInputs, build_media_document
from docweave.plans.refresh import deltas_between, earlier, refresh_documents
from docweave.plans.registry import TWINS, query, with_views
from docweave.session import fresh_dir, materialize
from docweave.sources.scans import incremental_scan


def _joined(ids: str, names: str, order: str) -> str:
    return f"string_agg(CAST({ids} AS VARCHAR), ',' ORDER BY {order}) AS a, string_agg({names}, ',' ORDER BY {order}) AS b"


A_TAG = f"a_tag AS (SELECT id, {_joined('tag_id', 'tag_name', 'tag_id')} FROM v_tag GROUP BY id)"
A_CATEGORY = f"""a_category AS (SELECT id, {_joined('category_id', 'category_name', 'category_id')},
  string_agg(CAST(standard_cate_id AS VARCHAR), ',' ORDER BY standard_cate_id) AS s FROM v_category GROUP BY id)"""
A_AREA = f"""a_area AS (SELECT id, {_joined('area_id', 'area_name', 'area_id')},
  string_agg(CAST(standard_area_id AS VARCHAR), ',' ORDER BY standard_area_id) AS s FROM v_area GROUP BY id)"""
_PEOPLE = "priority DESC, apriority DESC, person_id DESC"
A_DIRECTOR = f"a_director AS (SELECT id, {_joined('person_id', 'person_name', _PEOPLE)} FROM v_director GROUP BY id)"
A_ACTOR = f"a_actor AS (SELECT id, {_joined('person_id', 'person_name', _PEOPLE)} FROM v_person GROUP BY id)"
A_OTHER = """a_other AS (SELECT a.id, string_agg(DISTINCT b.source, ',' ORDER BY b.source) AS a FROM v_media a
  JOIN v_media b ON a.channel_id = b.channel_id AND a.name = b.name AND a.id <> b.id GROUP BY a.id)"""


def _children(view: str, ids: str, names: str, extra: str = "") -> str:
    return f"SELECT v_doc.id, coalesce(a, '') AS {ids}, coalesce(b, '') AS {names}{extra} FROM v_doc LEFT JOIN {view} USING (id)"


def _base(t: Tables) -> DataFrame:
    return t.doc.select("id")


def _tags(t: Tables) -> DataFrame:
    return enrich.bridge_enrich(t.tag_pairs, t.tag, key="id", dim_key="tag_id", name_col="tag_name", ids_as="tag_ids", names_as="tags")


@query("c1_bridge_tags", with_views(V_DOC, V_TAG, A_TAG, select=_children("a_tag", "tag_ids", "tags")))
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return enrich.attach(_base(t), _tags(t), "id")


@query(
    "c2_bridge_categories",
    with_views(V_DOC, V_CATEGORY, A_CATEGORY, select=_children("a_category", "category_ids", "categories", ", coalesce(s, '') AS standard_cate_ids")),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    enriched = enrich.bridge_enrich(
        t.category_pairs, t.category, key="id", dim_key="category_id", name_col="category_name",
        ids_as="category_ids", names_as="categories", standard_col="standard_cate_id", standard_as="standard_cate_ids",
    )
    return enrich.attach(_base(t), enriched, "id")


@query(
    "c3_bridge_areas",
    with_views(V_DOC, V_AREA, A_AREA, select=_children("a_area", "area_ids", "areas", ", coalesce(s, '') AS standard_area_ids")),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    enriched = enrich.bridge_enrich(
        t.area_pairs, t.area, key="id", dim_key="area_id", name_col="area_name",
        ids_as="area_ids", names_as="areas", standard_col="standard_area_id", standard_as="standard_area_ids",
    )
    return enrich.attach(_base(t), enriched, "id")


@query("c4_bridge_directors", with_views(V_DOC, V_DIRECTOR, A_DIRECTOR, select=_children("a_director", "director_ids", "director")))
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    people = enrich.people_enrich(
        t.director_bridge, t.person, key="id", dim_key="person_id", name_col="person_name", ids_as="director_ids", names_as="director"
    )
    return enrich.attach(_base(t), people, "id")


@query("c5_bridge_actors", with_views(V_DOC, V_PERSON, A_ACTOR, select=_children("a_actor", "actor_ids", "actor")))
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    people = enrich.people_enrich(
        t.person_bridge, t.person, key="id", dim_key="person_id", name_col="person_name", ids_as="actor_ids", names_as="actor"
    )
    return enrich.attach(_base(t), people, "id")


_C6 = with_views(V_DOC, V_CHANNEL, select="SELECT id, cust_id AS channel_id, channel_name, channel_code FROM v_doc LEFT JOIN v_channel ON cust_id = channel_id")


@query("c6_lookup_channel", _C6)
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return enrich.lookup(t.doc.select("id", F.col("cust_id").alias("channel_id")), t.channel, "channel_id")


@query("c6_lookup_channel_salted", _C6)
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return enrich.lookup(t.doc.select("id", F.col("cust_id").alias("channel_id")), t.channel, "channel_id", salted=True)


@query("c7_child_rollup", with_views(V_DOC, V_CHILD, select="SELECT id, newest FROM v_doc LEFT JOIN v_child USING (id)"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    newest = enrich.newest_child(t.child, "id", "child_time", "newest", F.col("disable") == 0)
    return enrich.child_rollup_join(_base(t), newest, "id")


_C8 = """WITH p AS (SELECT p_partkey AS id, p_size % 5 AS channel, p_name AS name, p_brand AS source FROM part),
  o AS (SELECT a.id, string_agg(DISTINCT b.source, ',' ORDER BY b.source) AS s FROM p a
        JOIN p b ON a.channel = b.channel AND a.name = b.name AND a.id <> b.id
        WHERE NOT (a.channel = 2 AND b.source IN ('Brand#1', 'Brand#7')) GROUP BY a.id)
  SELECT id, coalesce(s, '') AS exclude_source FROM p LEFT JOIN o USING (id)"""


def _same_names(spark: SparkSession, sf: str, salted: bool) -> DataFrame:
    parts = Tables(spark, sf).table("part").select(
        F.col("p_partkey").alias("id"), (F.col("p_size") % 5).alias("channel"), F.col("p_name").alias("name"), F.col("p_brand").alias("source")
    )
    sources = enrich.same_name_sources(
        parts, key="id", group=["channel", "name"], source="source", excluded={2: ["Brand#1", "Brand#7"]}, channel="channel", salted=salted
    )
    return sources.select("id", "exclude_source")


@query("c8_same_name_sources", _C8)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _same_names(spark, sf, salted=False)


@query("c8_same_name_sources_salted", _C8)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _same_names(spark, sf, salted=True)


def media_inputs(t: Tables) -> MediaInputs:
    """The given tables in the roles of one application."""
    return MediaInputs(
        base=t.media, channel=t.channel, tag_bridge=t.tag_pairs, tag=t.tag, category_bridge=t.category_pairs, category=t.category,
        area_bridge=t.area_pairs, area=t.area, director_bridge=t.director_bridge, actor_bridge=t.person_bridge, person=t.person,
        episode=t.child,
    )


_DOCUMENT_VIEWS = (
    V_DOC, V_MEDIA, V_TAG, V_CATEGORY, V_AREA, V_PERSON, V_DIRECTOR, V_CHILD, V_CHANNEL,
    A_TAG, A_CATEGORY, A_AREA, A_DIRECTOR, A_ACTOR, A_OTHER,
)
_DOCUMENT = f"""
  SELECT m.id, m.channel_id, CAST(disable AS BIGINT) AS disable, price, name, source, extend, payment_info, language_media_id,
         row_number() OVER (ORDER BY m.id) AS version_id, channel_name, channel_code,
         coalesce(t.a, '') AS tag_ids, coalesce(t.b, '') AS tags,
         coalesce(c.a, '') AS category_ids, coalesce(c.b, '') AS categories, coalesce(c.s, '') AS standard_cate_ids,
         coalesce(r.a, '') AS area_ids, coalesce(r.b, '') AS areas, coalesce(r.s, '') AS standard_area_ids,
         coalesce(d.a, '') AS director_ids, coalesce(d.b, '') AS director, coalesce(x.a, '') AS actor_ids, coalesce(x.b, '') AS actor,
         coalesce(o.a, '') AS exclude_source, {BRANDS_SQL}, {STRATEGIES_SQL}, {PAYMENT_SQL.replace('id %', 'm.id %')},
         CASE WHEN m.id % 13 < 4 THEN 0 ELSE m.id % 9 END AS edu_priority, corner_type,
         CAST(language_media_id <> 0 AND language_media_id <> m.id AS BIGINT) AS language_disable,
         CASE WHEN m.id % 5 = 0 THEN 0 ELSE m.id END AS original_id, greatest(create_time, 0) AS create_time,
         greatest(update_time, coalesce(newest, 0)) AS update_time, source AS current_source, CAST(100 AS BIGINT) AS priority
  FROM v_media m LEFT JOIN a_tag t USING (id) LEFT JOIN a_category c USING (id) LEFT JOIN a_area r USING (id)
       LEFT JOIN a_director d USING (id) LEFT JOIN a_actor x USING (id) LEFT JOIN a_other o USING (id)
       LEFT JOIN v_child USING (id) LEFT JOIN v_channel h ON m.channel_id = h.channel_id"""


@query("c9_media_document", with_views(*_DOCUMENT_VIEWS, select=_DOCUMENT))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return build_media_document(media_inputs(Tables(spark, sf)))


CHANGED_NOW, CHANGED_PERIOD = 1_005_000_000, 1500 * 86_400


@query(
    "c9_media_document_incremental",
    with_views(
        *_DOCUMENT_VIEWS,
        select=f"""SELECT * EXCLUDE (version_id) FROM ({_DOCUMENT})
                   WHERE id IN (SELECT id FROM v_media WHERE update_time > {CHANGED_NOW} - {CHANGED_PERIOD})""",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The changed documents alone come out as in a full build."""
    t = Tables(spark, sf)
    changed = incremental_scan(t.media, "update_time", CHANGED_NOW, CHANGED_PERIOD)
    inputs = replace(media_inputs(t), base=changed, all_documents=t.media)
    return build_media_document(inputs, start_version=None)


@query("c9_media_document_refreshed", with_views(*_DOCUMENT_VIEWS, select=f"SELECT * EXCLUDE (version_id) FROM ({_DOCUMENT})"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of an earlier state of all tables, refreshed by the deltas of the tables, come out as in a full build."""
    after = media_inputs(Tables(spark, sf))
    before = earlier(after)
    old = materialize(build_media_document(before, start_version=None), "old-documents")
    return refresh_documents(old, after, deltas_between(before, after))


_COUNTS = """SELECT l_suppkey, count(DISTINCT l_orderkey) AS available_count FROM lineitem JOIN orders ON l_orderkey = o_orderkey
             WHERE o_orderstatus <> 'P' GROUP BY 1"""


@query(
    "c10_actor_document",
    f"""SELECT s_suppkey AS person_id, s_name AS person_name, CAST(floor(s_acctbal) AS BIGINT) AS apriority,
               coalesce(available_count, 0) AS available_count, row_number() OVER (ORDER BY s_suppkey) + 99 AS version_id
        FROM supplier LEFT JOIN ({_COUNTS}) ON s_suppkey = l_suppkey""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return build_actor_document(
        t.person, t.person_bridge, t.doc, person="person_id", key="id", enabled=F.col("disable") == 0, start_version=100
    )


RULES = [
    Rule(["db_app0_media"], ["fm_click", "FM_SIGNUP"], master_key="jobs"),
    Rule(["db_app.*", "other"], ["^fm_(view|error)$"], exclude_databases=["db_app1_media"], exclude_tables=["err"], master_key="jobs"),
    Rule(["*"], ["chase"], exclude_databases=["*"], exclude_tables=["fm_view"], master_key="jobs"),
]
_CATALOG = "catalog AS (SELECT DISTINCT db, tbl, tbl <> 'FM_signup' AS has_key FROM v_change)"


def _catalog(t: Tables) -> DataFrame:
    return t.change.select("db", "tbl").distinct().withColumn("has_key", F.col("tbl") != "FM_signup")


@query(
    "c11_rule_match",
    with_views(
        V_CHANGE, _CATALOG,
        select="""
  SELECT db, tbl, 0::BIGINT AS rule_id FROM catalog WHERE db = 'db_app0_media' AND lower(tbl) IN ('fm_click', 'fm_signup')
  UNION ALL SELECT db, tbl, 1 FROM catalog WHERE regexp_matches(db, 'db_app.*') AND regexp_matches(lower(tbl), '^fm_(view|error)$')
  UNION ALL SELECT db, tbl, 2 FROM catalog WHERE lower(tbl) = 'chase'""",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rule_match(_catalog(Tables(spark, sf)), RULES).select("db", "tbl", "rule_id")


@query(
    "g2_effective_rules",
    with_views(
        V_CHANGE, _CATALOG,
        select="""
  SELECT db, tbl, 0::BIGINT AS rule_id FROM catalog WHERE db = 'db_app0_media' AND lower(tbl) IN ('fm_click', 'fm_signup') AND has_key
  UNION ALL SELECT db, tbl, 1 FROM catalog WHERE regexp_matches(lower(tbl), '^fm_(view|error)$') AND lower(tbl) <> 'fm_view'""",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    effective = effective_rules(_catalog(Tables(spark, sf)), RULES)
    return require_rules(effective).select("db", "tbl", "rule_id")


@query("c11_rule_table", TWINS["c11_rule_match"])
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The same matches with the rules as a table."""
    return match_rules(_catalog(Tables(spark, sf)), rules_frame(spark, RULES)).select("db", "tbl", "rule_id")


@query("g2_effective_rule_table", TWINS["g2_effective_rules"])
def _(spark: SparkSession, sf: str) -> DataFrame:
    return effective_by_table(_catalog(Tables(spark, sf)), rules_frame(spark, RULES)).select("db", "tbl", "rule_id")


@query("c12_without", with_views(V_DOC, select="SELECT id, update_time FROM v_doc WHERE id NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    returned = t.child.filter("disable = 1")
    return without(t.doc.select("id", "update_time"), returned, "id")


POINT_START, LOG_START = 1_704_067_200, 1_704_153_600
_POINT = f"({POINT_START} + o_orderkey * 7919 % 2592000)"


@query(
    "c13_position_as_of",
    with_views(
        V_CHANGE,
        select=f"""
  SELECT id, asked_at, file, pos FROM (SELECT o_orderkey AS id, {_POINT} AS asked_at FROM orders)
  ASOF LEFT JOIN (SELECT event_time, max(file) AS file, max(pos) AS pos FROM v_change WHERE event_time >= {LOG_START} GROUP BY 1)
  ON asked_at >= event_time""",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    points = t.table("orders").select(F.col("o_orderkey").alias("id"), F.expr(_POINT).alias("asked_at"))
    log = t.change.select("file", "pos", "event_time")
    return position_as_of(log, points, log_ts="event_time", point_ts="asked_at", start=LOG_START)


@query(
    "c13_newest_position",
    with_views(V_CHANGE, select=f"SELECT max(file) AS file, max(pos) AS pos FROM v_change WHERE event_time BETWEEN {LOG_START} AND 1705000000"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return newest_position(Tables(spark, sf).change, "event_time", LOG_START, 1_705_000_000)


@query("d1_available_count", f"SELECT l_suppkey AS person_id, available_count FROM ({_COUNTS})")
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return enrich.available_count(
        t.person_bridge, t.doc, key="id", person="person_id", enabled=F.col("disable") == 0, count_as="available_count"
    )


@query("d1_available_count_delta", f"SELECT l_suppkey AS person_id, available_count FROM ({_COUNTS})")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of an earlier state and the signed deltas of the documents that changed."""
    t = Tables(spark, sf)
    after = (t.person_bridge, t.doc)
    place = F.pmod(F.xxhash64("id"), F.lit(50))
    old_pairs = t.person_bridge.withColumn("id", F.when(F.pmod(F.xxhash64("id", "person_id"), F.lit(40)) == 0, F.col("id") + 1).otherwise(F.col("id")))
    old_docs = t.doc.filter(place != 0).withColumn("disable", F.when(place < 3, 1 - F.col("disable")).otherwise(F.col("disable")))
    before = (old_pairs, old_docs)
    arguments = {"key": "id", "person": "person_id", "enabled": F.col("disable") == 0}
    counts = enrich.available_count(*before, **arguments, count_as="available_count")
    changed = [delta_of(b.select("id", c), a.select("id", c)) for b, a, c in zip(before, after, ("person_id", "disable"))]
    touched = union_of([keys_in(d, "id") for d in changed])
    return add_deltas(counts, count_deltas(before, after, touched, **arguments), "person_id", "available_count")


@query("d2_newest_child", with_views(V_CHILD, select="SELECT id, newest FROM v_child"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.newest_child(Tables(spark, sf).child, "id", "child_time", "newest", F.col("disable") == 0)


@query("d3_ordered_ids_and_names", with_views(V_TAG, A_TAG, select="SELECT id, a AS tag_ids, b AS tags FROM a_tag"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    named = t.tag_pairs.distinct().join(t.tag, "tag_id")
    return enrich.ordered_ids_and_names(named, "id", "tag_id", "tag_name", "tag_ids", "tags")


@query(
    "e3_ranked_people",
    with_views(
        V_PERSON,
        select=f"SELECT id, person_id, priority, apriority, row_number() OVER (PARTITION BY id ORDER BY {_PEOPLE}) AS rank FROM v_person",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    people = t.person_bridge.groupBy("id", "person_id").agg(F.max("priority").alias("priority"))
    people = people.join(t.person.select("person_id", "apriority"), "person_id").select("id", "person_id", "priority", "apriority")
    order = [F.col("priority").desc(), F.col("apriority").desc(), F.col("person_id").desc()]
    return rank_in_group(people, ["id"], order)


@query("h2_assign_versions", with_views(V_DOC, select="SELECT id, row_number() OVER (ORDER BY id) AS version_id FROM v_doc"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return assign_versions(_base(Tables(spark, sf)), "id")


@query(
    "f3_index_sort",
    with_views(
        V_DOC,
        select="SELECT id, update_time, id % 3 AS shard, row_number() OVER (ORDER BY update_time DESC, id) AS stored_at FROM v_doc",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Written in stored order; the position is read off the files as they lie."""
    doc = Tables(spark, sf).doc.select("id", "update_time")
    path = fresh_dir(spark, "sorted")
    index_sort(doc, "id", full=False).write.parquet(path)
    stored = spark.read.schema(doc.schema).parquet(path)
    ranked = assign_stored_positions(stored)
    return ranked.withColumn("shard", shard_of(F.col("id"), 3))


def assign_stored_positions(stored: DataFrame) -> DataFrame:
    """Position of each row by file number and row number in the file."""
    name = F.col("_metadata.file_name")
    # numbers of the task and of its file, padded: names alone are out of order from a hundred thousand files on
    task, part = (F.lpad(F.regexp_extract(name, pattern, 1), 12, "0") for pattern in (r"^part-(\d+)", r"-c(\d+)"))
    placed = stored.select("*", F.concat(task, part).alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    offsets = running_offsets(sizes, "_file", "_n", "_before")  # as many rows as files
    joined = placed.join(F.broadcast(offsets), "_file")
    return joined.withColumn("stored_at", F.col("_before") + F.col("_row") + 1).drop("_file", "_row", "_before")


def _grams(key: str, column: str, table: str) -> str:
    return f"""SELECT DISTINCT {key} AS doc, substr(w, 1, n) AS term
      FROM (SELECT {key}, unnest(list_distinct(regexp_split_to_array(lower({column}), '[^\\p{{L}}\\p{{N}}]+'))) AS w FROM {table}),
           (SELECT unnest(range(1, 21)) AS n) WHERE w <> '' AND n <= length(w)"""


@query(
    "k1_prefix_index",
    f"SELECT term, count(*) AS n_docs, min(doc) AS first_doc, max(doc) AS last_doc FROM ({_grams('p_partkey', 'p_name', 'part')}) GROUP BY 1",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_index(Tables(spark, sf).table("part"), "p_partkey", "p_name")


@query(
    "k1_prefix_index_texts",
    f"SELECT term, count(*) AS n_docs, min(doc) AS first_doc, max(doc) AS last_doc FROM ({_grams('doc_id', 'text', 'documents')}) GROUP BY 1",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_index(Tables(spark, sf).documents, "doc_id", "text")


@query("k1_prefix_postings", f"SELECT doc AS p_partkey, term FROM ({_grams('p_partkey', 'p_name', 'part')})")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_postings(Tables(spark, sf).table("part"), "p_partkey", "p_name")


FIELDS = {"p_name": SPELLED_WEIGHT, "p_type": NAME_WEIGHT, "p_brand": ALIAS_WEIGHT}


@query(
    "k2_weighted_postings",
    f"""SELECT term, doc AS p_partkey, CAST(sum(w) AS BIGINT) AS weight FROM (
          SELECT doc, term, 20 AS w FROM ({_grams('p_partkey', 'p_name', 'part')})
          UNION ALL SELECT doc, term, 10 FROM ({_grams('p_partkey', 'p_type', 'part')})
          UNION ALL SELECT doc, term, 5 FROM ({_grams('p_partkey', 'p_brand', 'part')})) GROUP BY 1, 2""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return weighted_postings(Tables(spark, sf).part, "p_partkey", FIELDS)


# Names and types run together, as in a language without blanks; the dictionary has their words and shorter heads of them.
V_SEGMENT = """RECURSIVE v_text AS (SELECT p_partkey AS id, unnest([0, 1]) AS field, unnest([replace(lower(p_name), ' ', ''), replace(lower(p_type), ' ', '')]) AS t FROM part),
  v_single AS (SELECT DISTINCT unnest(string_split(lower(p_name || ' ' || p_type), ' ')) AS w FROM part),
  v_cut AS (SELECT w FROM v_single WHERE length(w) > 3 UNION SELECT substr(w, 1, 3) FROM v_single UNION SELECT right(w, 4) FROM v_single),
  v_distinct AS (SELECT DISTINCT t FROM v_text),
  v_lens AS (SELECT t, pos, list(length(w)) AS lens FROM (SELECT t, unnest(range(1, length(t) + 1)) AS pos FROM v_distinct)
             JOIN v_cut ON substr(t, pos, length(w)) = w GROUP BY t, pos),
  v_best AS (
    SELECT t, length(t) + 1 AS pos, [{'c': 0, 'w': 0, 'l': 0}] AS s FROM v_distinct
    UNION ALL
    SELECT b.t, b.pos - 1, list_prepend(list_min(list_concat([{'c': b.s[1].c, 'w': b.s[1].w, 'l': 0}],
      list_transform(coalesce(l.lens, []), lambda n: {'c': b.s[n].c - n, 'w': b.s[n].w + 1, 'l': -n}))), b.s)
    FROM v_best b LEFT JOIN v_lens l ON l.t = b.t AND l.pos = b.pos - 1 WHERE b.pos > 1),
  v_walk AS (
    SELECT t, 1 AS pos, s FROM v_best WHERE pos = 1
    UNION ALL
    SELECT t, pos + greatest(1, -s[pos].l), s FROM v_walk WHERE pos <= length(t)),
  v_step AS (SELECT t, pos, -s[pos].l AS n FROM v_walk WHERE pos <= length(t)),
  v_gap AS (SELECT t, pos, pos - row_number() OVER (PARTITION BY t ORDER BY pos) AS run FROM v_step WHERE n = 0),
  v_token AS (
    SELECT t, substr(t, pos, n) AS term FROM v_step WHERE n > 0
    UNION SELECT t, substr(t, min(pos), count(*)) FROM v_gap GROUP BY t, run)"""


def _run_together(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(texts, dictionary)"""
    t = Tables(spark, sf)
    part = t.part
    single = part.select(F.explode(F.split(F.lower(F.concat_ws(" ", "p_name", "p_type")), " ")).alias("w")).distinct()
    heads = single.select(F.explode(F.array(F.when(F.length("w") > 3, F.col("w")), F.substring("w", 1, 3), F.expr("right(w, 4)"))).alias("word"))
    # one entity writes all words; the same union as for every dictionary
    rows = heads.dropna().select("word", F.lit(0).alias("at"), F.lit(0).alias("key"))
    texts = part.select("p_partkey", F.regexp_replace("p_name", " ", "").alias("name"), F.regexp_replace("p_type", " ", "").alias("alias"))
    return texts, dictionary_union([(rows, "word", "at", "key")])


@query(
    "k2_segmented_words",
    with_views(V_SEGMENT, select="SELECT DISTINCT id AS p_partkey, term FROM v_text JOIN v_token USING (t) WHERE field = 0"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Names in words of the dictionary, which is broadcast after its size is measured."""
    texts, words = _run_together(spark, sf)
    cut = segment(texts, "p_partkey", ["name"], words)
    return cut.select("p_partkey", F.explode(F.array_distinct("name")).alias("term"))


@query(
    "k2_segmented_postings",
    with_views(
        V_SEGMENT,
        select=f"""SELECT term, doc AS p_partkey, CAST(sum(w) AS BIGINT) AS weight FROM (
          SELECT doc, term, 20 AS w FROM ({_grams('p_partkey', 'p_name', 'part')})
          UNION ALL SELECT DISTINCT id, term, CASE field WHEN 0 THEN 10 ELSE 5 END FROM v_text JOIN v_token USING (t)) GROUP BY 1, 2""",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Weights of prefixes and of words cut by a dictionary too large to broadcast."""
    texts, words = _run_together(spark, sf)
    cut = segment(texts, "p_partkey", ["name", "alias"], words, broadcast_chars=0)
    rows = Tables(spark, sf).part.select("p_partkey", "p_name").join(cut, "p_partkey")
    rows = materialize(rows, "segmented")  # read for the keys that repeat and for the postings
    return weighted_postings(rows, "p_partkey", {"p_name": SPELLED_WEIGHT}, {"name": NAME_WEIGHT, "alias": ALIAS_WEIGHT})
