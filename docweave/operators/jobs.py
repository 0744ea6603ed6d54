"""Queue of change jobs: order, depth, parsing and expansion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# digits and commas, a digit at both ends
_IDS = r"^[0-9](?:[0-9,]*[0-9])?$"


def next_jobs(queue: DataFrame, n: int) -> DataFrame:
    """The ``n`` members with the lowest score; ties in member order."""
    return queue.orderBy(F.col("score").asc(), F.col("member").asc()).limit(n)


def last_jobs(queue: DataFrame, n: int, offset: int = 0) -> DataFrame:
    """The ``n`` members with the highest score after ``offset``; ties in reverse member order."""
    return queue.orderBy(F.col("score").desc(), F.col("member").desc()).offset(offset).limit(n)


def queue_depth(members: DataFrame, queue: str, limit: int) -> DataFrame:
    """Members per queue and whether the queue is full."""
    depth = members.groupBy(queue).agg(F.count(F.lit(1)).alias("depth"))
    return depth.withColumn("is_full", (F.col("depth") >= limit).cast("int"))


def parse_jobs(jobs: DataFrame, member: str = "member", apps: list[str] | None = None) -> DataFrame:
    """``app``, ``entity``, ``op``, ``ids``, ``retry`` and ``reject_reason`` of ``app_entity[_delete]:ids[@n]``.

    Valid jobs have a NULL reason. ``apps`` limits the applications that are accepted.
    """
    split_up = jobs.withColumn("_parts", F.split(F.col(member), ":"))
    split_up = split_up.withColumns(
        {"_tail": F.split(F.get("_parts", F.lit(1)), "@"), "_action": F.split(F.get("_parts", F.lit(0)), "_")}
    )
    ids, retry = F.get("_tail", F.lit(0)), F.get("_tail", F.lit(1))
    app, op = F.get("_action", F.lit(0)), F.coalesce(F.get("_action", F.lit(2)), F.lit(""))
    supported = app.isin(apps) if apps else F.lit(True)
    reason = (
        F.when(F.size("_parts") != 2, "format")
        .when(F.size("_tail") > 2, "retry format")
        .when((F.size("_tail") == 2) & ~(retry.rlike(r"^[+-]?[0-9]+$") & retry.try_cast("int").isNotNull()), "retry number")
        .when(~ids.rlike(_IDS), "ids")
        .when((F.size("_action") < 2) | ~supported, "action")
        .when(~op.isin("", "delete"), "operation")
    )
    valid = F.col("reject_reason").isNull()
    return split_up.withColumn("reject_reason", reason).select(
        *jobs.columns,
        F.when(valid, app).alias("app"),
        F.when(valid, F.get("_action", F.lit(1))).alias("entity"),
        F.when(valid, op).alias("op"),
        F.when(valid, ids).alias("ids"),
        F.when(valid, F.coalesce(retry.try_cast("int"), F.lit(0))).alias("retry"),
        "reject_reason",
    )


def explode_jobs(parsed: DataFrame, id_as: str = "id") -> DataFrame:
    """One row per id of the valid jobs."""
    # rejected jobs have NULL ids and give no row
    ids = F.split("ids", ",+").cast("array<bigint>")
    return parsed.select("app", "entity", "op", "retry", F.explode(ids).alias(id_as))
