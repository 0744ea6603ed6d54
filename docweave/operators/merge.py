"""Upserts, deletes and updates of a keyed target without a table format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def upsert_merge(target: DataFrame, updates: DataFrame, key: str | list[str]) -> DataFrame:
    """Partial upsert: columns the update has overwrite, others stay, new keys are inserted.

    Presence is a matter of schema: a NULL in an update column overwrites. Both sides have one row
    per key, of one column or several. The target is only ever the left side of a left join and a semi join, so a small batch is broadcast, by
    its measured size, and a large target is not shuffled for it; the new keys are found on the batch.
    """
    keys = [key] if isinstance(key, str) else key
    marked = updates.select(*keys, *[F.col(c).alias(f"_u_{c}") for c in updates.columns if c not in keys], F.lit(True).alias("_u"))
    kept, fresh = [F.col(k) for k in keys], [F.col(k) for k in keys]
    for name in [c for c in target.columns if c not in keys]:
        if name in updates.columns:
            kept.append(F.when(F.col("_u"), F.col(f"_u_{name}")).otherwise(F.col(name)).alias(name))
            fresh.append(F.col(name))
        else:
            kept.append(F.col(name))
            fresh.append(F.lit(None).cast(target.schema[name].dataType).alias(name))
    added = [c for c in updates.columns if c not in target.columns]
    known = target.select(*keys).join(updates.select(*keys), keys, "left_semi")
    changed = target.join(marked, keys, "left").select(*kept, *[F.col(f"_u_{c}").alias(c) for c in added])
    return changed.union(updates.join(known, keys, "left_anti").select(*fresh, *added))


def without(base: DataFrame, ids: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows whose key is not listed."""
    keys = [key] if isinstance(key, str) else key
    return base.join(ids.select(*keys).distinct(), keys, "left_anti")


def route_disabled(df: DataFrame, is_full: bool, key: str, flag: str = "disable") -> tuple[DataFrame, DataFrame]:
    """(upserts, deletes): full mode keeps all rows, else disabled ones become deletes."""
    if is_full:
        return df, df.filter(F.lit(False)).select(key)
    enabled = F.coalesce(F.col(flag), F.lit(0)) == 0
    return df.filter(enabled), df.filter(~enabled).select(key)


def apply_batch(target: DataFrame, batch: DataFrame, key: str, is_full: bool = False, flag: str = "disable") -> DataFrame:
    """Deletes, then upserts of one batch with one row per key.

    One merge does both: a disabled row removes its key.
    """
    if is_full:
        return upsert_merge(target, batch, key)
    gone = F.coalesce(F.col(flag), F.lit(0)) != 0
    merged = upsert_merge(target.withColumn("_gone", F.lit(False)), batch.withColumn("_gone", gone), key)
    return merged.filter(~F.col("_gone")).drop("_gone")


def update_by_ids(target: DataFrame, ids: DataFrame, key: str, column: str, value: Column) -> DataFrame:
    """A constant in one column of all listed rows."""
    marked = ids.select(key).distinct().withColumn("_hit", F.lit(True))
    hit = target.join(marked, key, "left")
    return hit.withColumn(column, F.when(F.col("_hit"), value).otherwise(F.col(column))).drop("_hit")


def update_by_map(target: DataFrame, values: DataFrame, key: str) -> DataFrame:
    """Values per key from a table with one row per key; rows without an entry stay."""
    columns = [c for c in values.columns if c != key]
    marked = values.select(key, *[F.col(c).alias(f"_v_{c}") for c in columns], F.lit(True).alias("_hit"))
    joined = target.join(marked, key, "left")
    picked = []
    for name in target.columns:
        if name in columns:
            picked.append(F.when(F.col("_hit"), F.col(f"_v_{name}")).otherwise(F.col(name)).alias(name))
        else:
            picked.append(F.col(name))
    return joined.select(*picked)


def dispatch_brands(dispatch: DataFrame, key: str, enable: str, brand: str, brands_as: str = "inject_brands") -> DataFrame:
    """Dispatch rows as a brand list: the brand where the row is enabled, else an empty list."""
    enabled = F.array(F.lit(brand))
    return dispatch.select(key, F.when(F.col(enable) == 1, enabled).otherwise(F.array().cast("array<string>")).alias(brands_as))


def update_expr(target: DataFrame, condition: Column, assignments: dict[str, Column]) -> DataFrame:
    """Assignments on the rows that meet the condition, all computed from the old row."""
    picked = {
        name: F.when(condition, value).otherwise(F.col(name)).alias(name) for name, value in assignments.items()
    }
    return target.select(*[picked.get(c, F.col(c)) for c in target.columns])


def bulk_outcome_summary(outcomes: DataFrame, action: str, failed: str) -> DataFrame:
    """Succeeded and failed rows per action. The ids themselves stay rows, see ``succeeded_ids``."""
    return outcomes.groupBy(action).agg(
        F.count_if(~F.col(failed)).alias("n_success"), F.count_if(F.col(failed)).alias("n_failed")
    )


def succeeded_ids(submitted: DataFrame, failed: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct submitted ids that did not fail."""
    return submitted.select(*keys).distinct().join(failed.select(*keys).distinct(), keys, "left_anti")


def app_view(entities: dict[str, DataFrame]) -> DataFrame:
    """All entities of an application behind one name; absent columns are NULL."""
    combined = None
    for name, df in entities.items():
        named = df.withColumn("entity", F.lit(name))
        combined = named if combined is None else combined.unionByName(named, allowMissingColumns=True)
    return combined
