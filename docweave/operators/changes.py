"""Change-data capture: images, keys, tags and the five materialised structures.

A change has ``file`` and ``pos`` (its place in the log) and an ``action``. The last change of a key
is found with ``max_by``, which combines map-side, so a key with a third of all changes costs one row
per map task after the combine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docweave.functions.convert import safe_score
from docweave.operators.numbering import global_index

POSITION = ("file", "pos")
BULK_SIZE = 1000


def position() -> Column:
    """A change's place in the log as one comparable value."""
    return F.struct(*POSITION)


def pair_images(rows: DataFrame, event: list[str], index: str, image: list[str]) -> DataFrame:
    """Before and after images of update events, whose rows alternate old, new, old, new.

    Pairs are formed by row number within the event, so a large event is spread over many tasks.
    """
    odd = F.col(index) % 2 == 1
    fields = F.struct(*image)
    paired = rows.groupBy(*event, F.floor(F.col(index) / 2).cast("long").alias("pair_no")).agg(
        F.max(F.when(~odd, fields)).alias("old"), F.max(F.when(odd, fields)).alias("new")
    )
    return paired.filter(F.col("new").isNotNull())


def change_key(keys: list[tuple[Column, Column | None]]) -> Column:
    """Key text of a change: the new value, else the old one; several columns give ``[a+b]``."""
    parts = []
    for new, old in keys:
        value = new if old is None else F.coalesce(new, old)
        parts.append(F.coalesce(value.cast("string"), F.lit("")))
    if len(parts) == 1:
        return parts[0]
    joined = F.regexp_replace(F.concat_ws("+", *parts), r"\++$", "")
    return F.concat(F.lit("["), joined, F.lit("]"))


def tag_base(db: Column, tbl: Column) -> Column:
    """``app_entity`` from a three-part database and a table of two or more parts; NULL otherwise."""
    db_parts, tbl_parts = F.split(db, "_"), F.split(tbl, "_")
    valid = (F.size(db_parts) == 3) & (F.size(tbl_parts) >= 2)
    text = F.concat_ws("_", F.lower(F.get(db_parts, F.lit(1))), F.lower(F.get(tbl_parts, F.lit(1))))
    return F.when(valid, text)


def tag_reject(db: Column, tbl: Column) -> Column:
    """Why a change has no tag; NULL where it has one."""
    return F.when(F.size(F.split(db, "_")) != 3, "database segments").when(
        F.size(F.split(tbl, "_")) < 2, "table segments"
    )


def change_tag(db: Column, tbl: Column, action: Column, key: Column, prefix: str = "", mark_delete: bool = True) -> Column:
    """``app_entity[_delete]:key``; the prefix is for string and hash keys."""
    suffix = F.when((action == "delete") & F.lit(mark_delete), F.lit("_delete")).otherwise(F.lit(""))
    return F.concat(F.lit(prefix), tag_base(db, tbl), suffix, F.lit(":"), key)


def latest_per_key(changes: DataFrame, keys: list[str]) -> DataFrame:
    """The last change of every key in log order."""
    rest = [c for c in changes.columns if c not in keys]
    last = F.max_by(F.struct(*rest), position())
    return changes.groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.*")


def kv_state(changes: DataFrame, key: Column, value: list[str]) -> DataFrame:
    """Current ``key`` -> JSON row. A delete removes the key; NULL columns are left out of the JSON."""
    return _state(changes, {"key": key}, value)


def hash_state(changes: DataFrame, master_key: Column, sub_key: Column, value: list[str]) -> DataFrame:
    """Current JSON row under (``key``, ``sub_key``)."""
    return _state(changes, {"key": master_key, "sub_key": sub_key}, value)


def _state(changes: DataFrame, keys: dict[str, Column], value: list[str]) -> DataFrame:
    columns = [c.alias(name) for name, c in keys.items()]
    # only the last image is serialised to JSON
    keyed = changes.select(*columns, *POSITION, "action", F.struct(*value).alias("_row"))
    last = latest_per_key(keyed.filter(_all_present(list(keys))), list(keys))
    return last.filter(F.col("action") != "delete").select(*keys, F.to_json("_row").alias("value"))


def _all_present(names: list[str]) -> Column:
    present = F.lit(True)
    for name in names:
        present = present & F.col(name).isNotNull()
    return present


def append_log(changes: DataFrame, tag: Column) -> DataFrame:
    """Every tag in log order; readers order by (file, pos)."""
    return changes.select(*POSITION, tag.alias("tag")).filter(F.col("tag").isNotNull())


def distinct_set(changes: DataFrame, tag: Column) -> DataFrame:
    """Distinct tags."""
    return changes.select(tag.alias("member")).filter(F.col("member").isNotNull()).distinct()


def scored_set(changes: DataFrame, tag: Column, score: Column | None, event_time: Column) -> DataFrame:
    """Members with their last score: the score column as text, or the event time where it is absent."""
    fallback = event_time.cast("double")
    scored = fallback if score is None else F.when(score.isNull(), fallback).otherwise(safe_score(score.cast("string")))
    members = changes.select(tag.alias("member"), scored.alias("_score"), *POSITION)
    return (
        members.filter(F.col("member").isNotNull())
        .groupBy("member")
        .agg(F.max_by("_score", position()).alias("score"))
    )


def flush_batches(changes: DataFrame, bulk_size: int = BULK_SIZE) -> DataFrame:
    """Changes with ``batch_no``: consecutive runs of ``bulk_size`` changes in log order."""
    numbered = global_index(changes, *POSITION, name="_no", start=0)
    return numbered.withColumn("batch_no", F.expr(f"_no div {bulk_size}")).drop("_no")


def compact_ids(batched: DataFrame, queue: Column, tag: Column, key: Column, time: Column, distinct: bool = False) -> DataFrame:
    """Per batch, queue and tag the keys in log order, comma-joined.

    A group never exceeds one batch, so the collected list is bounded by the flush size.
    """
    rows = batched.select(
        "batch_no", queue.alias("queue"), tag.alias("tag"), key.alias("_key"), time.alias("_time"), *POSITION
    ).filter((F.col("_key") != "") & F.col("tag").isNotNull())
    entries = F.sort_array(F.collect_list(F.struct(*POSITION, F.col("_key").alias("key"))))
    ids = F.transform(entries, lambda e: e["key"])
    if distinct:
        ids = F.array_distinct(ids)
    return rows.groupBy("batch_no", "queue", "tag").agg(
        F.concat_ws(",", ids).alias("ids"), F.count(F.lit(1)).alias("n_ids"), F.max("_time").alias("score")
    )


def compact_jobs(compacted: DataFrame) -> DataFrame:
    """Compacted ids as scored queue members ``tag:ids``; an equal member keeps its last score."""
    members = compacted.select(
        "queue", F.concat_ws(":", "tag", "ids").alias("member"), F.col("score").cast("double").alias("score"), "batch_no"
    )
    return members.groupBy("queue", "member").agg(F.max_by("score", "batch_no").alias("score"))


def replay_from(changes: DataFrame, file: str, pos: int) -> DataFrame:
    """Changes strictly after a saved position; plain comparisons, so files can be skipped."""
    return changes.filter((F.col("file") > file) | ((F.col("file") == file) & (F.col("pos") > pos)))


def last_position(changes: DataFrame) -> DataFrame:
    """The position to save after these changes: one row."""
    return changes.agg(F.max(position()).alias("_p")).select("_p.*")


def bootstrap_and_tail(snapshot: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """A dump overlaid with the changes that follow it.

    The dump rows enter at the position before the first change.
    """
    dumped = snapshot.withColumn("file", F.lit("")).withColumn("pos", F.lit(0).cast("long")).withColumn("action", F.lit("insert"))
    combined = dumped.select(*changes.columns).unionByName(changes)
    last = latest_per_key(combined, keys)
    return last.filter(F.col("action") != "delete").drop("action", *POSITION)
