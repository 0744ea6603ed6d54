"""Consume change jobs: take them in order, send every id to the entity of its job, select its row again, build, apply, and keep account of failures."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from docweave.operators.jobs import next_jobs, parse_jobs
from docweave.operators.merge import upsert_merge, without
from docweave.operators.retry import retry_ledger
from docweave.session import materialize


@dataclass(frozen=True)
class Route:
    """Where the jobs of some tags (``app_entity``) go.

    ``build`` makes documents of selected ``source`` rows. Where several tags share a source and a target, ``tag`` names the column of
    both that tells whose row it is; the same id may then stand for a document of each tag.
    """

    tags: list[str]
    source: DataFrame
    target: DataFrame
    key: str = "id"
    tag: str | None = None
    build: Callable[[DataFrame], DataFrame] = lambda rows: rows

    def __post_init__(self) -> None:
        if len(self.tags) != 1 and self.tag is None:
            raise ValueError("several tags need a column that tells them apart")

    @property
    def keys(self) -> list[str]:
        return [self.key] if self.tag is None else [self.tag, self.key]


@dataclass(frozen=True)
class Consumed:
    """The targets after the jobs in the order of the routes, what is left to do, the failures' ledger, and jobs that could not be used."""

    targets: list[DataFrame]
    queue: DataFrame
    ledger: DataFrame
    rejected: DataFrame
    exhausted: DataFrame


def taken_ids(jobs: DataFrame, tags: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """((tag, id, op) of the last job of every id of a tag, rejected jobs) of taken jobs (member, score).

    ``tags`` are those that have an entity; a job of another tag is rejected.
    """
    tag = F.concat_ws("_", "app", "entity")
    parsed = parse_jobs(jobs)
    if tags is not None:
        parsed = parsed.withColumn("reject_reason", F.when(F.col("reject_reason").isNull() & ~tag.isin(tags), "entity").otherwise(F.col("reject_reason")))
    listed = parsed.filter("reject_reason is null").select(
        "score", "member", tag.alias("tag"), "op", F.explode(F.split("ids", ",+").cast("array<bigint>")).alias("id")
    )
    last = listed.groupBy("tag", "id").agg(F.max_by("op", F.struct("score", "member")).alias("op"))
    return last, parsed.filter("reject_reason is not null").select("member", "reject_reason")


def consume_jobs(
    queue: DataFrame, n: int, routes: list[Route], *, ledger: DataFrame, now: int, failed: DataFrame | None = None
) -> Consumed:
    """Take the next ``n`` jobs off ``queue`` (member, score) and apply each to the target of its tag.

    The last job of an id of a tag decides: a delete removes its document, else its row of the source is built
    and upserted; ids without a row change nothing. ``failed`` (tag, id) are ids whose application failed: their documents stay as they were
    and they are queued again by the retry rules.
    """
    taken = materialize(next_jobs(queue, n), "taken-jobs")  # fixed once, so that targets and queue agree
    ids, rejected = taken_ids(taken, [tag for route in routes for tag in route.tags])
    if failed is not None:
        marked = failed.select("tag", "id").distinct().withColumn("failed", F.lit(True))
        ids = ids.join(marked, ["tag", "id"], "left").withColumn("failed", F.coalesce("failed", F.lit(False)))
    else:
        ids = ids.withColumn("failed", F.lit(False))
    ids = materialize(ids, "taken-ids")
    good = ids.filter("not failed")
    retried = retry_ledger(ids.select(F.concat_ws("_", "tag", F.when(F.col("op") != "", F.col("op"))).alias("tag"), "id", "failed"), ledger, now)
    left = queue.join(taken.select("member"), "member", "left_anti").select("member", "score")
    targets = [_applied(route, good.filter(F.col("tag").isin(route.tags))) for route in routes]
    return Consumed(targets, left.unionByName(retried.requeue), retried.ledger, rejected, retried.exhausted)


def _applied(route: Route, ids: DataFrame) -> DataFrame:
    """The target of a route after its ids (tag, id, op)."""
    named = ids.select(*([] if route.tag is None else [F.col("tag").alias(route.tag)]), F.col("id").alias(route.key), "op")
    rows = route.source.join(named.filter("op = ''").select(*route.keys), route.keys, "left_semi")
    # written first: the merge broadcasts a small batch by its measured size and does not shuffle the target for it
    built = materialize(route.build(rows), "built-documents")
    changed = upsert_merge(route.target, built, route.keys)
    return without(changed, named.filter("op = 'delete'"), route.keys)
