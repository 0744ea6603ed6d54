"""Rules that say which tables are followed.

Rules are a short configuration list, so they become one expression over the catalogue or the change
feed: no join, no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

_REGEX_CHARS = set("\\.+*?()|[]{}^$")


@dataclass(frozen=True)
class Rule:
    """Databases and tables to follow or to leave out, as names or patterns."""

    databases: list[str]
    tables: list[str]
    exclude_databases: list[str] = field(default_factory=list)
    exclude_tables: list[str] = field(default_factory=list)
    structure: str = "list"
    master_key: str = ""
    key_prefix: str = ""
    key_columns: list[str] = field(default_factory=list)
    score_column: str = ""
    strategy: str = "segmented"
    include_columns: list[str] = field(default_factory=list)
    exclude_columns: list[str] = field(default_factory=list)
    date_pattern: str = ""
    datetime_pattern: str = ""

    def __post_init__(self) -> None:
        if not [d for d in self.databases if d] or not [t for t in self.tables if t]:
            raise ValueError("database or table cannot be empty for a rule")
        if self.structure not in STRUCTURES:
            raise ValueError(f"structure must be one of {', '.join(STRUCTURES)}")
        if self.structure != "string" and not self.master_key:
            raise ValueError(f"structure {self.structure} needs a master key")


STRUCTURES = ("string", "hash", "list", "set", "sortedset")


def _name_matches(value: Column, pattern: str) -> Column:
    """Exact for a plain name, an unanchored pattern otherwise; ``*`` is everything. Case is ignored."""
    if pattern == "*":
        return F.lit(True)
    if _REGEX_CHARS & set(pattern):
        return value.rlike(f"(?i){pattern}")
    return F.lower(value) == pattern.lower()


def _any_of(value: Column, patterns: list[str]) -> Column:
    matched = F.lit(False)
    for pattern in patterns:
        if pattern:
            matched = matched | _name_matches(value, pattern)
    return matched


def rule_key(db: Column, tbl: Column) -> Column:
    """Lower-cased ``db:table``."""
    return F.lower(F.concat_ws(":", db, tbl))


def rule_match(catalog: DataFrame, rules: list[Rule]) -> DataFrame:
    """Every (table, rule) match of a catalogue with columns ``db`` and ``tbl``; ``rule_id`` from 0."""
    hits = [
        F.when(_any_of(F.col("db"), r.databases) & _any_of(F.col("tbl"), r.tables), F.lit(i)) for i, r in enumerate(rules)
    ]
    return catalog.withColumn("rule_id", F.explode(F.array_compact(F.array(*hits))))


def rule_of(rules: list[Rule]) -> Column:
    """Number of the last rule that includes a change's ``db`` and ``tbl``; NULL where none does or one excludes it."""
    included = [
        F.when(_any_of(F.col("db"), r.databases) & _any_of(F.col("tbl"), r.tables), F.lit(i))
        for i, r in reversed(list(enumerate(rules)))
    ]
    excluded = F.lit(False)
    for r in rules:
        excluded = excluded | (_any_of(F.col("db"), r.exclude_databases) & _any_of(F.col("tbl"), r.exclude_tables))
    return F.when(~excluded, F.coalesce(*included))


def effective_rules(catalog: DataFrame, rules: list[Rule], skip_no_key: bool = True) -> DataFrame:
    """Tables some rule includes and no rule excludes, with the last including rule.

    ``has_key`` in the catalogue tells whether the table has a primary key; tables without one are
    skipped, or fail the query.
    """
    matched = catalog.withColumn("rule_id", rule_of(rules)).filter(F.col("rule_id").isNotNull())
    if "has_key" not in catalog.columns:
        return matched
    if skip_no_key:
        return matched.filter("has_key")
    message = F.concat(F.lit("table must have a primary key: "), rule_key(F.col("db"), F.col("tbl")))
    return matched.withColumn("has_key", F.when(F.col("has_key"), F.lit(True)).otherwise(F.raise_error(message)))


def require_rules(effective: DataFrame) -> DataFrame:
    """The rules themselves, or an error where none is left."""
    if effective.isEmpty():
        raise ValueError("there is no rule left")
    return effective


def apply_rules(changes: DataFrame, widths: dict[str, int], row: str = "row") -> DataFrame:
    """Changes of followed tables whose row has the declared number of columns.

    ``widths`` maps the rule key of a followed table to its column count.
    """
    pairs = [F.lit(item) for key, width in widths.items() for item in (key.lower(), width)]
    keyed = changes.withColumn("rule_key", rule_key(F.col("db"), F.col("tbl")))
    # an unknown table has no width and is dropped by the same comparison
    return keyed.filter(F.size(row) == F.try_element_at(F.create_map(*pairs), F.col("rule_key")))
