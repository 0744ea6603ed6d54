"""Row selection: by key, id list, time range, recent change or page limit."""

from __future__ import annotations

import re
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F

from docweave.operators.numbering import global_index

# Entities whose disabled rows are kept (fixed values).
KEEP_DISABLED = frozenset(
    ["topic", "media", "episode", "video", "anchor", "dispatch", "actor", "play", "appexternal", "dict"]
)

_ID_LIST = re.compile(r"\d(?:[\d,]*\d)?")
_TIME_FORMAT = "%Y-%m-%d %H:%M:%S"


def snapshot_scan(df: DataFrame, key: str, resume_id: int = 0) -> DataFrame:
    """All rows from ``resume_id`` on; the comparison reaches the file or JDBC scan."""
    return df.filter(F.col(key) >= F.lit(resume_id))


def parse_ids(text: str) -> list[int]:
    """Ids of a comma list; full-width commas, blanks and edge commas are tolerated."""
    cleaned = text.replace("，", ",").replace(" ", "").strip(",")
    if not _ID_LIST.fullmatch(cleaned):
        raise ValueError(f"invalid id list: {text!r}")
    return [int(part) for part in cleaned.split(",") if part]


def id_list_scan(df: DataFrame, key: str, ids: str | list) -> DataFrame:
    """Rows whose key is listed.

    The list is given in the key's own type. Its range is a plain comparison that reaches the files, the exact test a semi
    join; both are the same for any length of the list.
    """
    wanted = parse_ids(ids) if isinstance(ids, str) else list(ids)
    if not wanted:
        return df.filter(F.lit(False))
    kind = df.schema[key].dataType
    ordered = sorted(map(str, wanted)) if kind.typeName() in ("string", "varchar", "char") else sorted(wanted)
    low, high = (F.lit(str(i)).cast(kind) for i in (ordered[0], ordered[-1]))
    texts = df.sparkSession.createDataFrame([(str(i),) for i in wanted], "_listed string")
    listed = texts.select(F.col("_listed").cast(kind).alias(key)).distinct()
    return df.filter(F.col(key).between(low, high)).join(listed, key, "left_semi")


def parse_time_range(start: str, end: str) -> tuple[int, int] | None:
    """Epoch bounds of two ``yyyy-MM-dd HH:mm:ss`` texts; both or none, end after start."""
    bounds = []
    for text in (start.strip(), end.strip()):
        if not text:
            bounds.append(0)
            continue
        bounds.append(int(datetime.strptime(text, _TIME_FORMAT).replace(tzinfo=timezone.utc).timestamp()))
    if bounds == [0, 0]:
        return None
    return _check_range(bounds[0], bounds[1])


def _check_range(start: int, end: int) -> tuple[int, int]:
    if start <= 0 or end <= 0 or end <= start:
        raise ValueError("both times must be positive and the end later than the start")
    return start, end


def _bound(df: DataFrame, ts: str, seconds: int) -> Column:
    """Epoch seconds as a literal of the column's own type, so that the comparison reaches the files."""
    kind = df.schema[ts].dataType.typeName()
    if kind not in ("timestamp", "timestamp_ntz"):
        return F.lit(seconds)
    text = datetime.fromtimestamp(seconds, timezone.utc).strftime(_TIME_FORMAT)
    return F.lit(text).cast(kind)


def time_range_scan(df: DataFrame, ts: str, start: int, end: int) -> DataFrame:
    """Rows with ``start <= ts <= end``; bounds are epoch seconds, the column a number or a timestamp."""
    low, high = _check_range(start, end)
    return df.filter(F.col(ts).between(_bound(df, ts, low), _bound(df, ts, high)))


def incremental_scan(df: DataFrame, ts: str, now: int, period: int) -> DataFrame:
    """Rows changed after ``now - period``; ``now`` is explicit so that reruns give the same rows."""
    return df.filter(F.col(ts) > _bound(df, ts, now - period))


def enabled_filter(df: DataFrame, entity: str, flag: str = "disable") -> DataFrame:
    """Enabled rows only, unless all rows of the entity are kept."""
    if entity in KEEP_DISABLED:
        return df
    return df.filter(F.col(flag) == 0)


def select_rows(
    df: DataFrame,
    key: str,
    ts: str,
    *,
    now: int | None = None,
    period: int | None = None,
    ids: str = "",
    time_range: tuple[int, int] | None = None,
    resume_id: int = 0,
) -> DataFrame:
    """One entry for all selections; update wins over ids, ids over time range, that over resume."""
    if now is not None and period is not None:
        return incremental_scan(df, ts, now, period)
    if ids:
        return id_list_scan(df, key, ids)
    if time_range is not None:
        return time_range_scan(df, ts, *time_range)
    return snapshot_scan(df, key, max(resume_id, 0))


def split_plan(df: DataFrame, key: str, page_size: int) -> DataFrame:
    """Pages in key order: ``page_no`` (from 0), ``start_key``, ``rows``."""
    numbered = global_index(df.select(key), key, name="_no", start=0)
    return (
        numbered.groupBy(F.expr(f"_no div {page_size}").alias("page_no"))
        .agg(F.min(key).alias("start_key"), F.count(F.lit(1)).alias("rows"))
    )


def value_at_rank(df: DataFrame, column: str | Column, rank: int, accuracy: int = 10_000) -> tuple[int | float, int]:
    """The ``rank``-th smallest value (from 1) of a numeric column without nulls, and how many rows lie below it.

    A quantile sketch, which tasks merge, gives two values around the rank; the rows between them are counted, and sketched again if they are
    not one value. Every step is an aggregation that reads the column alone and leaves about one row in ``accuracy / 4``: nothing is sorted or written.
    """
    values, below = df.select(F.col(column).alias("v") if isinstance(column, str) else column.alias("v")), 0
    while True:
        rows = values.count()
        if not 1 <= rank - below <= rows:
            raise ValueError("no row of this rank")
        wanted, error = rank - below, 2 * rows // accuracy
        around = [max(wanted - error, 1) / rows, min(wanted + error, rows) / rows]
        low, high = values.agg(F.percentile_approx("v", around, accuracy)).first()[0]
        less, upto, least_high, upto_high = values.agg(
            F.count_if(F.col("v") < low), F.count_if(F.col("v") <= low), F.count_if(F.col("v") < high), F.count_if(F.col("v") <= high)
        ).first()
        for value, before, after in ((low, less, upto), (high, least_high, upto_high)):
            if before < wanted <= after:
                return value, below + before
        if wanted <= less:
            values = values.filter(F.col("v") < low)
        elif wanted > upto_high:
            values, below = values.filter(F.col("v") > high), below + upto_high
        else:
            values, below = values.filter((F.col("v") > low) & (F.col("v") < high)), below + upto


def paged_limit(df: DataFrame, key: str, page_size: int, page_limit: int) -> DataFrame:
    """The first ``page_limit`` pages in order of a numeric key, nulls first.

    Rows with equal keys come in the order of the hash of their columns. The last key, and where it is shared the last hash, are found
    by sketches of these columns; the table is only filtered. Of rows equal in all columns at the cut as many are kept as fit.
    """
    wanted = page_size * page_limit
    if wanted < 1:
        return df.limit(0)
    unknown = df.filter(F.col(key).isNull())
    nulls, rows = df.select(F.count_if(F.col(key).isNull()), F.count(F.lit(1))).first()
    if wanted >= rows:
        return df
    if wanted <= nulls:
        return _first_by_hash(unknown, wanted)
    last, below = value_at_rank(df.filter(F.col(key).isNotNull()), key, wanted - nulls)
    before = df.filter(F.col(key).isNull() | (F.col(key) < last))
    return before.unionByName(_first_by_hash(df.filter(F.col(key) == last), wanted - nulls - below))


def _first_by_hash(df: DataFrame, wanted: int) -> DataFrame:
    """The first rows in order of the hash of their columns."""
    row_hash = F.shiftright(F.xxhash64(*df.columns), 11)  # 53 bits, which a sketch tells apart
    last, below = value_at_rank(df, row_hash, wanted)
    equal = df.filter(row_hash == last).limit(wanted - below)  # equal rows, whichever they are
    return df.filter(row_hash < last).unionByName(equal)
