"""A change log as a stream whose offset is the log position itself.

The log is a folder of Parquet files with ``file`` and ``pos`` among their columns; it grows by files whose positions lie behind
those before. ``spark.readStream.format("change_log").schema(...).option("from_file", f).option("from_pos", p).load(path)`` starts strictly
behind any saved position, without a checkpoint; with a checkpoint it goes on where the query ended. The offset of
a batch, ``{"file": ..., "pos": ...}``, is what a reader would save to start again after it.

Files are placed by the bounds in their footers, which are read once for each file. Where a Parquet file holds several log files its
last position comes from its two position columns. A batch reads the files whose bounds meet it and keeps the changes inside; ``max_changes``
limits it at file ends.

``PositionStore`` keeps saved positions as rows of a small folder; the last one saved counts, also one set back by hand.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

Position = tuple[str, int]
START: Position = ("", -1)


@dataclass(frozen=True)
class LogFile:
    """A Parquet file of the log with its first and last position and its changes."""

    path: str
    low: Position
    high: Position
    rows: int


@dataclass
class ChangeRange(InputPartition):
    """Changes of a file after ``begin`` up to ``end``."""

    path: str
    begin: Position
    end: Position


def _bounds(system: pafs.FileSystem, path: str) -> LogFile | None:
    """Footer bounds; exact ones from the position columns where a file holds several log files."""
    with system.open_input_file(path) as opened:
        parquet = pq.ParquetFile(opened)
        meta = parquet.metadata
        if not meta.num_rows:
            return None
        places = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
        groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
        stats = [[g.column(places[c]).statistics for c in ("file", "pos")] for g in groups]
        if all(s is not None and s.has_min_max for pair in stats for s in pair):
            names = {s.min for s, _ in stats} | {s.max for s, _ in stats}
            if len(names) == 1:
                name = names.pop()
                return LogFile(path, (name, min(p.min for _, p in stats)), (name, max(p.max for _, p in stats)), meta.num_rows)
        low, high = None, None
        for batch in parquet.iter_batches(columns=["file", "pos"]):
            for pick in (min, max):
                name = getattr(pc, pick.__name__)(batch.column("file"))
                pos = getattr(pc, pick.__name__)(batch.column("pos").filter(pc.equal(batch.column("file"), name)))
                value = (name.as_py(), pos.as_py())
                if pick is min:
                    low = value if low is None else min(low, value)
                else:
                    high = value if high is None else max(high, value)
        return LogFile(path, low, high, meta.num_rows)


class ChangeLogReader(DataSourceStreamReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.schema = options["path"], schema
        self.start = (options.get("from_file", START[0]), int(options.get("from_pos", START[1])))
        self.max_changes = int(options.get("max_changes", 0))
        self.files: dict[str, LogFile | None] = {}
        self.given: Position | None = None  # the last offset given out or read

    def _log_files(self) -> list[LogFile]:
        system, root = pafs.FileSystem.from_uri(self.path)
        inside = system.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
        for info in inside:
            if info.is_file and info.path.endswith(".parquet") and "/_" not in info.path[len(root) :] and info.path not in self.files:
                self.files[info.path] = _bounds(system, info.path)
        return sorted((f for f in self.files.values() if f is not None), key=lambda f: (f.high, f.path))

    def initialOffset(self) -> dict:
        return _offset(self.start)

    def latestOffset(self) -> dict:
        at = self.given or self.start
        taken = 0
        for file in self._log_files():
            if file.high <= at:
                continue
            if self.max_changes and taken and taken + file.rows > self.max_changes:
                break
            taken += file.rows
            at = file.high
        return _offset(at)

    def partitions(self, start: dict, end: dict) -> list[ChangeRange]:
        begin, upto = _position(start), _position(end)
        self.given = upto
        return [ChangeRange(f.path, begin, upto) for f in self._log_files() if f.high > begin and f.low <= upto]

    def commit(self, end: dict) -> None:
        self.given = _position(end)

    def read(self, partition: ChangeRange) -> Iterator[pa.RecordBatch]:
        system, _ = pafs.FileSystem.from_uri(self.path)
        wanted = to_arrow_schema(self.schema)
        with system.open_input_file(partition.path) as opened:
            parquet = pq.ParquetFile(opened)
            columns = sorted({*wanted.names, "file", "pos"} & set(parquet.schema_arrow.names))
            for batch in parquet.iter_batches(columns=columns):
                inside = pc.and_(_after(batch, partition.begin), pc.invert(_after(batch, partition.end)))
                kept = batch.filter(inside)
                if kept.num_rows:
                    yield pa.RecordBatch.from_arrays([_column(kept, f) for f in wanted], schema=wanted)


def _column(batch: pa.RecordBatch, field: pa.Field) -> pa.Array:
    """A column in the declared type; NULL where the file has none of its name."""
    if field.name not in batch.schema.names:
        return pa.nulls(batch.num_rows, field.type)
    return batch.column(field.name).cast(field.type)


def _after(batch: pa.RecordBatch, at: Position) -> pa.Array:
    """Which changes lie strictly behind a position."""
    file, pos = batch.column("file"), batch.column("pos")
    return pc.or_(pc.greater(file, at[0]), pc.and_(pc.equal(file, at[0]), pc.greater(pos, at[1])))


def _offset(at: Position) -> dict:
    return {"file": at[0], "pos": at[1]}


def _position(offset: dict) -> Position:
    return offset["file"], int(offset["pos"])


class ChangeLog(DataSource):
    """``change_log``"""

    @classmethod
    def name(cls) -> str:
        return "change_log"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return ChangeLogReader(self.options, schema)


def follow_changes(
    spark: SparkSession, path: str, schema: StructType, after: Position | None = None, max_changes: int | None = None
) -> DataFrame:
    """A stream of the changes strictly after a position, of all where there is none."""
    spark.dataSource.register(ChangeLog)
    reader = spark.readStream.format("change_log").schema(schema)
    if after is not None:
        reader = reader.option("from_file", after[0]).option("from_pos", after[1])
    if max_changes:
        reader = reader.option("max_changes", max_changes)
    return reader.load(path)


class PositionStore:
    """Saved positions below ``path``; the last one saved counts."""

    SCHEMA = "file string, pos long, saved_at long"

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def save(self, at: Position) -> None:
        """Save a position, later or earlier than the one before."""
        self.spark.createDataFrame([(*at, time.time_ns())], self.SCHEMA).coalesce(1).write.mode("append").json(self.path)

    def save_last(self, changes: DataFrame) -> Position | None:
        """Save the position of the last change of a batch; without changes nothing is saved."""
        last = changes.agg(F.max(F.struct("file", "pos")).alias("_p")).first()["_p"]
        if last is None:
            return None
        self.save((last["file"], last["pos"]))
        return last["file"], last["pos"]

    def load(self) -> Position | None:
        """The last position saved; None where there is none."""
        try:
            row = self.spark.read.schema(self.SCHEMA).json(self.path).orderBy(F.desc("saved_at")).first()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return None if row is None else (row["file"], row["pos"])
