"""Wide documents: arrays from bridge tables, lookups and child roll-ups.

Every child is reduced to one row per document before it is attached, so array joins cannot
multiply rows and all of them share the partitioning on the document key. The pairs of a bridge are
made distinct first: that collapses a hot document map-side, and an array is then no longer than the
list of distinct dimension ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docweave.operators.skew import salted_join


def _descending(column: str) -> Column:
    return (-F.col(column)).alias(f"_d_{column}")


def ordered_ids_and_names(pairs: DataFrame, key: str, id_col: str, name_col: str, ids_as: str, names_as: str) -> DataFrame:
    """Per key: distinct ids ascending, names in the order of the ids."""
    return _ordered(pairs, key, id_col, name_col, ids_as, names_as)


def _ordered(pairs, key, id_col, name_col, ids_as, names_as, standard_col=None, standard_as=None) -> DataFrame:
    """One aggregation, so one shuffle: the sets are built before it, which collapses repeated pairs of a hot key."""
    aggregates = [F.sort_array(F.collect_set(F.struct(F.col(id_col).alias("id"), F.col(name_col).alias("name")))).alias("_e")]
    if standard_col:
        of_id = F.struct(F.col(standard_col).alias("standard"), F.col(id_col).alias("id"))
        aggregates.append(F.sort_array(F.collect_set(of_id)).alias("_s"))
    columns = [
        key,
        F.transform("_e", lambda e: e["id"]).alias(ids_as),
        F.transform("_e", lambda e: e["name"]).alias(names_as),
    ]
    if standard_col:
        standards = F.filter(F.transform("_s", lambda s: s["standard"]), lambda s: s.isNotNull())
        columns.append(standards.alias(standard_as))
    return pairs.groupBy(key).agg(*aggregates).select(*columns)


def bridge_enrich(
    bridge: DataFrame,
    dim: DataFrame,
    *,
    key: str,
    dim_key: str,
    name_col: str,
    ids_as: str,
    names_as: str,
    standard_col: str | None = None,
    standard_as: str | None = None,
) -> DataFrame:
    """Aligned id and name arrays per document; the standard ids are sorted on their own."""
    pairs = bridge.select(key, dim_key).join(dim, dim_key)
    return _ordered(pairs, key, dim_key, name_col, ids_as, names_as, standard_col, standard_as)


def people_enrich(
    bridge: DataFrame,
    dim: DataFrame,
    *,
    key: str,
    dim_key: str,
    name_col: str,
    ids_as: str,
    names_as: str,
    priority: str = "priority",
    person_priority: str = "apriority",
) -> DataFrame:
    """Directors or actors per document by bridge priority, then person priority, then id, all descending.

    A person listed twice for a document counts once, with the highest priority.
    """
    pairs = bridge.groupBy(key, dim_key).agg(F.max(priority).alias(priority)).join(dim, dim_key)
    entry = F.struct(
        _descending(priority),
        _descending(person_priority),
        _descending(dim_key),
        F.col(dim_key).alias("id"),
        F.col(name_col).alias("name"),
    )
    grouped = pairs.groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias("_e"))
    return grouped.select(
        key,
        F.transform("_e", lambda e: e["id"]).alias(ids_as),
        F.transform("_e", lambda e: e["name"]).alias(names_as),
    )


def attach(base: DataFrame, enriched: DataFrame, key: str) -> DataFrame:
    """Left join by document key; documents without a match get empty arrays."""
    joined = base.join(enriched, key, "left")
    for field in enriched.schema.fields:
        if field.dataType.typeName() == "array":
            empty = F.array().cast(field.dataType)
            joined = joined.withColumn(field.name, F.coalesce(F.col(field.name), empty))
    return joined


def lookup(base: DataFrame, dim: DataFrame, key: str, salted: bool = False) -> DataFrame:
    """Left join with a dimension that has one row per key.

    The join strategy follows the measured size of the dimension: small ones are broadcast by the
    planner or by adaptive execution, large ones are shuffled and hot keys split. ``salted`` spreads
    hot keys without relying on adaptive execution.
    """
    if salted:
        return salted_join(base, dim, [key], "left")
    return base.join(dim, key, "left")


def newest_child(children: DataFrame, key: str, updated: str, newest_as: str, enabled: Column | None = None) -> DataFrame:
    """Latest update time of the enabled children per parent."""
    kept = children if enabled is None else children.filter(enabled)
    return kept.groupBy(key).agg(F.max(updated).alias(newest_as))


def child_rollup_join(base: DataFrame, newest: DataFrame, key: str) -> DataFrame:
    """Parents with their newest child; parents without children keep NULL."""
    return base.join(newest, key, "left")


def available_count(bridge: DataFrame, documents: DataFrame, *, key: str, person: str, enabled: Column, count_as: str) -> DataFrame:
    """Number of enabled documents per person, each document counted once."""
    open_documents = documents.filter(enabled).select(key)
    pairs = bridge.select(key, person).distinct()
    return pairs.join(open_documents, key, "left_semi").groupBy(person).agg(F.count(F.lit(1)).alias(count_as))


def same_name_sources(
    base: DataFrame,
    *,
    key: str,
    group: list[str],
    source: str,
    sources_as: str = "exclude_source",
    excluded: dict[int, list[str]] | None = None,
    channel: str | None = None,
    salted: bool = False,
    population: DataFrame | None = None,
) -> DataFrame:
    """Sources of the *other* documents with the same channel and name, sorted.

    No pairs are formed: a group is reduced to its distinct sources with the lowest and highest key
    of each. A source belongs to another document unless both equal the document's own key.
    ``excluded`` lists, per channel, sources that are left out. ``population`` has the documents to compare with
    where ``base`` is only a part of them; just the groups of ``base`` are read from it.
    """
    everyone = base
    if population is not None:
        everyone = population.select(key, *group, source).join(base.select(*group).distinct(), group, "left_semi")
    per_source = everyone.groupBy(*group, source).agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
    entry = F.struct(F.col(source).alias("source"), F.col("lo"), F.col("hi"))
    per_group = per_source.groupBy(*group).agg(F.sort_array(F.collect_list(entry)).alias("_sources"))
    joined = salted_join(base, per_group, group) if salted else base.join(per_group, group, "left")
    others = F.filter(F.col("_sources"), lambda s: (s["lo"] != F.col(key)) | (s["hi"] != F.col(key)))
    names = F.coalesce(F.transform(others, lambda s: s["source"]), F.array().cast("array<string>"))
    for channel_id, hidden in (excluded or {}).items():
        without = F.array_except(names, F.array(*[F.lit(h) for h in hidden]))
        names = F.when(F.col(channel) == channel_id, without).otherwise(names)
    return joined.withColumn(sources_as, names).drop("_sources")
