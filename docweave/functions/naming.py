"""Names of actions, snapshots and documents."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_NAME = r"^([a-z_]+?)(\d{14}|\d{6})(_dev)?$"
# Document types with a letter of their own inside the id (fixed values).
TYPE_LETTERS = {"media": "m", "video": "v"}


def parse_index_name(name: Column) -> Column:
    """``base``, ``stamp``, ``is_dev`` and ``prefix`` of a versioned name; NULL where it is none."""
    base = F.regexp_extract(name, _NAME, 1)
    parts = F.split(base, "_")
    prefix = F.when(F.size(parts) > 1, F.concat(parts[0], F.lit("_"), F.get(parts, F.lit(1)), F.lit("_")))
    return F.when(
        name.rlike(_NAME),
        F.struct(
            base.alias("base"),
            F.regexp_extract(name, _NAME, 2).alias("stamp"),
            (F.regexp_extract(name, _NAME, 3) != "").cast("int").alias("is_dev"),
            F.coalesce(prefix, F.lit("")).alias("prefix"),
        ),
    )


def action_segments(action: Column) -> Column:
    """``app``, ``entity``, ``op`` of a two- or three-part action; NULL for any other number of parts."""
    parts = F.split(action, "_")
    return F.when(
        F.size(parts).between(2, 3),
        F.struct(
            parts[0].alias("app"),
            F.get(parts, F.lit(1)).alias("entity"),
            F.coalesce(F.get(parts, F.lit(2)), F.lit("")).alias("op"),
        ),
    )


def doc_id(app: Column, entity: Column, key: Column, doc_type: Column | None = None) -> Column:
    """``app_entity_key``; typed documents carry their letter before the entity."""
    letter = F.lit("")
    if doc_type is not None:
        for name, mark in TYPE_LETTERS.items():
            letter = F.when(doc_type == name, F.lit(mark)).otherwise(letter)
    return F.concat(app, F.lit("_"), letter, entity, F.lit("_"), key.cast("string"))


def snapshot_name(app: str, entity: str, stamp: str, dev: bool = False) -> str:
    """Name of a versioned snapshot."""
    return f"{app}_{entity}{stamp}{'_dev' if dev else ''}"
