"""Newest log position at a point in time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

DAY = 86_400


def position_as_of(log: DataFrame, points: DataFrame, *, log_ts: str, point_ts: str, start: int | None = None) -> DataFrame:
    """Every point with ``file`` and ``pos`` of the newest log row whose time is not later.

    Times are epoch seconds. Both sides are first reduced to one row per second, so a day holds at
    most 2 * 86,400 rows whatever the traffic; a running maximum inside the day is completed by the
    maximum of the earlier days, one row per day. ``start`` leaves out older log rows.
    """
    rows = log if start is None else log.filter(F.col(log_ts) >= start)
    per_second = rows.groupBy(F.col(log_ts).alias("_sec")).agg(F.max(F.struct("file", "pos")).alias("_at"))
    asked = points.select(F.col(point_ts).alias("_sec")).distinct()
    at_type = per_second.schema["_at"].dataType
    marks = per_second.withColumn("_asked", F.lit(False)).unionByName(
        asked.select("_sec", F.lit(None).cast(at_type).alias("_at"), F.lit(True).alias("_asked"))
    )
    marks = marks.withColumn("_day", F.floor(F.col("_sec") / DAY).cast("long"))
    in_day = Window.partitionBy("_day").orderBy("_sec").rangeBetween(Window.unboundedPreceding, 0)
    running = marks.withColumn("_now", F.max("_at").over(in_day)).filter("_asked")
    per_day = marks.groupBy("_day").agg(F.max("_at").alias("_at"))
    # one row per calendar day: a single task is enough, and the broadcast is as small
    earlier = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_day.select("_day", F.max("_at").over(earlier).alias("_carry"))
    found = running.join(F.broadcast(carry), "_day").select("_sec", F.greatest("_now", "_carry").alias("_best"))
    joined = points.join(found, points[point_ts] == found["_sec"], "left")
    return joined.select(*[points[c] for c in points.columns], F.col("_best.file").alias("file"), F.col("_best.pos").alias("pos"))


def newest_position(log: DataFrame, log_ts: str, start: int, at: int) -> DataFrame:
    """The newest position with ``start <= time <= at``: one row."""
    kept = log.filter(F.col(log_ts).between(start, at))
    return kept.agg(F.max(F.struct("file", "pos")).alias("_p")).select("_p.*")
