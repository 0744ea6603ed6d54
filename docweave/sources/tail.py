"""Follow growing log files: a stream source whose offset is the bytes read of every file.

``spark.readStream.format("tail_lines").load(path)`` gives the lines of one file, of the files it was rotated to (``path`` with
a ``.`` or ``-`` and more behind it), or of all files of a folder, from their first byte on. Only whole lines are read;
the rest of a line comes with its end. A file is known by a hash of its first line, so it goes on where it was left when it is renamed, and a file
that takes its name, or is truncated and written anew, begins at its first byte. (Two files whose first lines are equal count as one;
access logs begin with a time.) Files that appear and vanish between two looks are not seen.

A batch names bytes of files by their hash, so it is the same when it is repeated, even after a rotation. Long ranges are
split into tasks of ``split_bytes`` at line ends. ``max_bytes`` limits what a batch adds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SPLIT_BYTES = 64 << 20
MOST_HEAD = 1 << 16
_STEP = 1 << 16
_BATCH_LINES = 10_000
SCHEMA = "line string, file string, offset long"


@dataclass
class LineRange(InputPartition):
    """Lines of a file that begin in ``[begin, end)``; ``first`` if a line begins at ``begin`` for certain."""

    file: str
    begin: int
    end: int
    first: bool


class Files:
    """The files of a path, by the hash of their first line."""

    def __init__(self, path: str):
        self.system, self.root = pafs.FileSystem.from_uri(path)
        self.root = self.root.rstrip("/")

    def names(self) -> list[tuple[str, int]]:
        """(path, size) of the file and what it was rotated to, or of all files of the folder."""
        info = self.system.get_file_info(self.root)
        if info.type == pafs.FileType.Directory:
            inside = self.system.get_file_info(pafs.FileSelector(self.root, recursive=True))
            return sorted((f.path, f.size) for f in inside if f.is_file and not f.base_name.startswith(("_", ".")))
        folder, _, name = self.root.rpartition("/")
        beside = self.system.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
        return sorted((f.path, f.size) for f in beside if f.is_file and (f.base_name == name or f.base_name.startswith((f"{name}.", f"{name}-"))))

    def identity(self, path: str) -> str | None:
        """Hash of the first line, or of as much of it as is read; None while it is not complete."""
        with self.system.open_input_file(path) as file:
            head = b""
            while b"\n" not in head and len(head) < MOST_HEAD:
                more = file.read(4096)
                if not more:
                    return None
                head += more
        return blake2b(head[:MOST_HEAD].split(b"\n", 1)[0], digest_size=12).hexdigest()

    def whole_lines(self, path: str, size: int) -> int:
        """Bytes up to the end of the last whole line."""
        with self.system.open_input_file(path) as file:
            end = min(size, file.size())
            while end > 0:
                begin = max(0, end - _STEP)
                at = file.read_at(end - begin, begin).rfind(b"\n")
                if at >= 0:
                    return begin + at + 1
                end = begin
        return 0

    def found(self) -> dict[str, tuple[str, int]]:
        """identity -> (path, bytes of whole lines); the longest where two files have the same."""
        out: dict[str, tuple[str, int]] = {}
        for path, size in self.names():
            try:
                key = self.identity(path)
                if key is not None:
                    out[key] = max(out.get(key, ("", -1)), (path, self.whole_lines(path, size)), key=lambda f: f[1])
            except FileNotFoundError:  # renamed meanwhile: found under its new name at the next look
                continue
        return out

    def path_of(self, key: str) -> str:
        """Where a file is now."""
        for path, _ in self.names():
            try:
                if self.identity(path) == key:
                    return path
            except FileNotFoundError:
                continue
        raise FileNotFoundError(f"no file below {self.root} begins with the line {key}")


class TailReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.split_bytes = int(options.get("split_bytes", SPLIT_BYTES))
        self.max_bytes = int(options.get("max_bytes", 0))
        self.known: dict[str, int] = {}  # offsets given out or read

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        ends = {key: size for key, (_, size) in Files(self.path).found().items()}
        left = self.max_bytes or None
        now = dict(self.known)  # a file that is out of sight stays, so that it is not read again
        for key in sorted(ends):
            before = self.known.get(key, 0)
            before = 0 if ends[key] < before else before
            grown = ends[key] - before
            taken = grown if left is None else min(grown, left)
            if 0 < taken < grown:
                taken = self._up_to_line(key, before, taken)
            if left is not None:
                left = max(0, left - taken)
            now[key] = before + taken
        return dict(sorted((k, v) for k, v in now.items() if v or k in self.known))

    def _up_to_line(self, key: str, before: int, taken: int) -> int:
        """The lines that fit into a limit, one at least."""
        files = Files(self.path)
        path = files.path_of(key)
        whole = files.whole_lines(path, before + taken)
        if whole > before:
            return whole - before
        with files.system.open_input_file(path) as file:
            at = before
            while (cut := file.read_at(_STEP, at).find(b"\n")) < 0:
                at += _STEP
        return at + cut + 1 - before

    def partitions(self, start: dict, end: dict) -> list[LineRange]:
        self.known = dict(end)
        out = []
        for key, upto in sorted(end.items()):
            begin = start.get(key, 0)
            begin = 0 if upto < begin else begin  # written anew
            for at in range(begin, upto, self.split_bytes):
                out.append(LineRange(key, at, min(at + self.split_bytes, upto), at == begin))
        return out

    def commit(self, end: dict) -> None:
        self.known = dict(end)

    def read(self, partition: LineRange) -> Iterator[pa.RecordBatch]:
        files = Files(self.path)
        lines: list[str] = []
        offsets: list[int] = []

        def batch() -> pa.RecordBatch:
            names = pa.array([partition.file] * len(lines), pa.string())
            return pa.record_batch([pa.array(lines, pa.string()), names, pa.array(offsets, pa.int64())], names=["line", "file", "offset"])

        with files.system.open_input_file(files.path_of(partition.file)) as file:
            at = partition.begin if partition.first else partition.begin - 1
            rest, skip = b"", not partition.first  # the line that begins before belongs to the range before
            begin = at
            while begin < partition.end:
                more = file.read_at(_STEP, begin + len(rest))
                if not more:
                    break
                parts = (rest + more).split(b"\n")
                rest = parts.pop()
                for part in parts:
                    if begin >= partition.end:
                        break
                    if not skip:
                        lines.append(part.decode(errors="replace").removesuffix("\r"))
                        offsets.append(begin)
                    skip = False
                    begin += len(part) + 1
                if len(lines) >= _BATCH_LINES:
                    yield batch()
                    lines, offsets = [], []
        if lines:
            yield batch()


class TailLines(DataSource):
    """``tail_lines``"""

    @classmethod
    def name(cls) -> str:
        return "tail_lines"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return TailReader(self.options)


def tail_lines(spark: SparkSession, path: str, max_bytes: int | None = None, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """A stream of (line, file, offset): whole lines of growing files; an absolute path or URI that all executors reach."""
    spark.dataSource.register(TailLines)
    reader = spark.readStream.format("tail_lines").option("split_bytes", split_bytes)
    if max_bytes:
        reader = reader.option("max_bytes", max_bytes)
    return reader.load(path)
