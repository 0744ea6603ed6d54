"""Bounded retries of failed ids."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

MAX_RETRY = 3
TTL_SECONDS = 3600


@dataclass(frozen=True)
class RetryResult:
    """The new ledger, the members to queue again, and the ids given up."""

    ledger: DataFrame
    requeue: DataFrame
    exhausted: DataFrame


def fold_outcomes(outcomes: DataFrame, ledger: DataFrame, now: int, max_retry: int = MAX_RETRY, ttl: int = TTL_SECONDS) -> DataFrame:
    """Every id of outcomes or ledger with its next ``times`` and its ``fate``.

    ``outcomes`` has ``tag``, ``id`` and ``failed``; an id with several outcomes in one batch failed
    if any of them did. ``ledger`` has ``tag``, ``id``, ``times`` and ``expires_at``.
    """
    batch = outcomes.groupBy("tag", "id").agg(F.bool_or("failed").alias("failed"))
    alive = ledger.filter(F.col("expires_at") > now)
    joined = batch.join(alive, ["tag", "id"], "full_outer")
    tried = F.coalesce(F.col("times"), F.lit(0))
    fate = (
        F.when(F.col("failed").isNull(), "waiting")
        .when(~F.col("failed"), "done")
        .when(tried >= max_retry, "exhausted")
        .otherwise("retry")
    )
    return joined.select(
        "tag",
        "id",
        F.when(F.col("failed"), tried + 1).otherwise(tried).cast("int").alias("times"),
        F.when(F.col("failed"), F.lit(now + ttl)).otherwise(F.col("expires_at")).cast("long").alias("expires_at"),
        fate.alias("fate"),
    )


def retry_ledger(outcomes: DataFrame, ledger: DataFrame, now: int, max_retry: int = MAX_RETRY, ttl: int = TTL_SECONDS) -> RetryResult:
    """One batch of outcomes applied to the ledger.

    A failed id counts 1 on its first failure and one more on each later one, and is queued again at
    the best score as ``tag:id@n``; at ``max_retry`` it is dropped and reported. Success clears the
    entry, and entries expire ``ttl`` seconds after their last failure.
    """
    folded = fold_outcomes(outcomes, ledger, now, max_retry, ttl)
    kept = folded.filter(F.col("fate").isin("waiting", "retry")).select("tag", "id", "times", "expires_at")
    member = F.concat(F.col("tag"), F.lit(":"), F.col("id").cast("string"), F.lit("@"), F.col("times").cast("string"))
    requeue = folded.filter(F.col("fate") == "retry").select(member.alias("member"), F.lit(0.0).alias("score"))
    exhausted = folded.filter(F.col("fate") == "exhausted").select("tag", "id", (F.col("times") - 1).alias("times"))
    return RetryResult(kept, requeue, exhausted)
