"""Changes to key-value requests and state, as each table's rule says.

Rules are a short list, so a change's request is one expression that picks by rule number: no join. The five
structures share one projection; their states differ in what counts as the same entry and whether a delete removes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType, StructType, TimestampNTZType, TimestampType

from docweave.functions.convert import null_fallback, safe_score
from docweave.operators.changes import POSITION, change_key, latest_per_key, position
from docweave.operators.rules import Rule, rule_of
from docweave.operators.strategy import strategy

_KEYED = ("string", "hash")
REQUEST = ["structure", "key", "sub_key", "value", "score", "action", *POSITION]


def _columns(rule: Rule, image: StructType) -> list[str]:
    """Columns of a rule's value: the listed ones or all but the excluded, always with the keys, in table order."""
    names = [f.name for f in image.fields]
    unknown = [c for c in [*rule.include_columns, *rule.key_columns, *filter(None, [rule.score_column])] if c not in names]
    if unknown:
        raise ValueError(f"not a table column: {', '.join(unknown)}")
    wanted = set(rule.include_columns) or set(names) - set(rule.exclude_columns)
    return [n for n in names if n in wanted or n in rule.key_columns]


def _formatted(value: Column, rule: Rule, kind) -> Column:
    if isinstance(kind, DateType) and rule.date_pattern:
        return F.date_format(value, rule.date_pattern)
    if isinstance(kind, (TimestampType, TimestampNTZType)) and rule.datetime_pattern:
        return F.date_format(value, rule.datetime_pattern)
    return value


def _request(rule: Rule, image: StructType, row: str, old: str | None) -> Column:
    """Structure, key, sub key, value and score of a change under one rule."""
    kinds = {f.name: f.dataType for f in image.fields}

    def new_and_old(name: str) -> tuple[Column, Column | None]:
        return F.col(f"{row}.{name}"), F.col(f"{old}.{name}") if old else None

    keys = rule.key_columns or image.fieldNames()[:1]
    key = change_key([new_and_old(c) for c in keys])
    # string and hash hold the row itself, so a delete works on the same key; the others name the operation
    action = F.lit("update") if rule.structure in _KEYED else F.col("action")
    tag = strategy(rule.strategy).tag(F.col("db"), F.col("tbl"), action, key)
    if rule.structure in _KEYED:
        fields = []
        for name in _columns(rule, image):
            new, before = new_and_old(name)
            value = new if before is None else null_fallback(new, before, F.col("action"))
            fields.append(_formatted(value, rule, kinds[name]).alias(name))
        value = F.to_json(F.struct(*fields))
    else:
        value = tag
    if rule.score_column:
        given = F.col(f"{row}.{rule.score_column}")
        score = F.when(given.isNull(), F.col("event_time").cast("double")).otherwise(safe_score(given.cast("string")))
    else:
        score = F.col("event_time").cast("double")
    none = F.lit(None).cast("string")
    return F.struct(
        F.lit(rule.structure).alias("structure"),
        (F.concat(F.lit(rule.key_prefix), tag) if rule.structure == "string" else F.when(tag.isNotNull(), F.lit(rule.master_key))).alias("key"),
        (F.concat(F.lit(rule.key_prefix), tag) if rule.structure == "hash" else none).alias("sub_key"),
        value.alias("value"),
        (score if rule.structure == "sortedset" else F.lit(None).cast("double")).alias("score"),
    )


def requests_of(changes: DataFrame, rules: list[Rule], row: str = "row", old: str | None = None) -> DataFrame:
    """One request for each change of a followed table: ``REQUEST``.

    ``changes`` has db, tbl, action, event_time, the position, the new image as a struct and maybe the old one. The last rule that includes
    a table decides. A change whose names give no tag has no request.
    """
    image = changes.schema[row].dataType
    picked = [F.when(F.col("_rule") == i, _request(rule, image, row, old)) for i, rule in enumerate(rules)]
    ruled = changes.withColumn("_rule", rule_of(rules)).filter(F.col("_rule").isNotNull())
    requested = ruled.select(F.coalesce(*picked).alias("_r"), "action", *POSITION).select("_r.*", "action", *POSITION)
    return requested.filter(F.col("key").isNotNull()).select(*REQUEST)


def state_of(requests: DataFrame) -> DataFrame:
    """What the requests leave behind: structure, key, sub_key, value, score, and the position of list entries.

    Strings and hash fields keep the last value and lose it by a delete, sets keep distinct members,
    sorted sets the last score of each; lists keep everything, to be read in order of position. All but the lists come from one
    aggregation by what counts as the same entry: the sub key of strings and hash fields, the value of the others.
    """
    out = ["structure", "key", "sub_key", "value", "score", *POSITION]
    no_position = [F.lit(None).cast(requests.schema[c].dataType).alias(c) for c in POSITION]
    keyed = F.col("structure").isin(*_KEYED)
    named = requests.filter(F.col("structure") != "list").withColumn("_entry", F.when(keyed, F.col("sub_key")).otherwise(F.col("value")))
    last = F.max_by(F.struct("sub_key", "value", "score", "action"), position()).alias("_last")
    entries = named.groupBy("structure", "key", "_entry").agg(last).select("structure", "key", "_last.*")
    entries = entries.filter(~keyed | (F.col("action") != "delete")).select(*out[:5], *no_position)
    return entries.unionByName(requests.filter("structure = 'list'").select(*out))
