"""The actor document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docweave.operators.enrich import available_count
from docweave.operators.numbering import assign_versions


def build_actor_document(
    actors: DataFrame, bridge: DataFrame, documents: DataFrame, *, person: str, key: str, enabled: Column, start_version: int = 1
) -> DataFrame:
    """Actors with the number of their enabled documents and a version number."""
    counts = available_count(bridge, documents, key=key, person=person, enabled=enabled, count_as="available_count")
    versions = assign_versions(actors.select(person), person, start_version)
    counted = actors.join(counts, person, "left").withColumn("available_count", F.coalesce("available_count", F.lit(0)))
    return counted.join(versions, person)
