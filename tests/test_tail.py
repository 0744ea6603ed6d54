import os
import random

import pytest

from docweave.sources.tail import Files, LineRange, TailReader, tail_lines


def drain(spark, path, checkpoint, out, **options):
    """Read what is there and go on at the next call; gives all lines so far with their places."""
    stream = tail_lines(spark, path, **options)
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return sorted((r["file"], r["offset"], r["line"]) for r in spark.read.parquet(out).collect())


def texts(rows):
    return sorted(line for _, _, line in rows)


def append(path, *lines, end="\n"):
    with open(path, "a", newline="") as file:
        file.write("\n".join(lines) + end)


def test_appends_rotation_truncation_and_restarts(spark, tmp_path):
    log, args = f"{tmp_path}/access.log", (f"{tmp_path}/access.log", f"{tmp_path}/cp", f"{tmp_path}/out")
    append(log, "1 first", "1 second", "1 half", end="")
    assert texts(drain(spark, *args)) == ["1 first", "1 second"]
    append(log, " and rest", "1 fourth")
    assert texts(drain(spark, *args)) == ["1 first", "1 fourth", "1 half and rest", "1 second"]
    append(log, "1 last before rotation")
    os.rename(log, log + ".1")
    append(log, "2 new file")
    append(log + ".1", "1 late line")
    expected = ["1 first", "1 fourth", "1 half and rest", "1 last before rotation", "1 late line", "1 second", "2 new file"]
    assert texts(drain(spark, *args)) == expected
    open(log, "w").close()
    append(log, "3 after truncation")
    assert texts(drain(spark, *args)) == sorted([*expected, "3 after truncation"])
    rows = drain(spark, *args)
    assert len({(f, o) for f, o, _ in rows}) == len(rows) == len(expected) + 1


def test_truncated_file_with_the_same_first_line_is_read_anew(spark, tmp_path):
    log, args = f"{tmp_path}/a.log", (f"{tmp_path}/a.log", f"{tmp_path}/cp", f"{tmp_path}/out")
    append(log, "same", "x", "y", "z")
    drain(spark, *args)
    open(log, "w").close()
    append(log, "same", "w")
    assert texts(drain(spark, *args)) == ["same", "same", "w", "x", "y", "z"]


def test_many_files_small_ranges_and_limits(spark, tmp_path):
    rng, expected = random.Random(4), []
    folder = tmp_path / "logs"
    folder.mkdir()
    for n in range(4):
        lines = [f"{n}-{i} " + "é" * rng.randrange(0, 60) for i in range(200)]
        append(f"{folder}/{n}.log", *lines, end="\r\n" if n == 1 else "\n")
        expected += lines
    (folder / "empty.log").touch()
    for n, options in enumerate([{"split_bytes": 97}, {}]):
        assert texts(drain(spark, str(folder), f"{tmp_path}/cp{n}", f"{tmp_path}/out{n}", **options)) == sorted(expected)
    seen = []
    while not seen or len(seen) < 9 and seen[-1] < len(expected):  # a limited batch at a time
        seen.append(len(drain(spark, str(folder), f"{tmp_path}/cp-limited", f"{tmp_path}/out-limited", max_bytes=20_000)))
    assert len(seen) > 2 and texts(drain(spark, str(folder), f"{tmp_path}/cp-limited", f"{tmp_path}/out-limited")) == sorted(expected)


def test_a_repeated_batch_is_the_same_after_a_rotation(tmp_path):
    log = f"{tmp_path}/a.log"
    append(log, "one", "two")
    reader = TailReader({"path": log})
    end = reader.latestOffset()
    before = [b for p in reader.partitions({}, end) for b in reader.read(p)]
    os.rename(log, log + "-20240101")
    append(log, "other")
    after = [b for p in TailReader({"path": log}).partitions({}, end) for b in reader.read(p)]
    assert [b.to_pylist() for b in before] == [b.to_pylist() for b in after]


def test_splits_hold_every_line_once(tmp_path):
    log = f"{tmp_path}/a.log"
    lines = ["", "a", "bb", "", "c" * 300, "d", ""]
    append(log, *lines)
    size, key = os.path.getsize(log), next(iter(Files(log).found()))
    reader = TailReader({"path": log})
    for step in range(1, size + 1):
        ranges = [LineRange(key, at, min(at + step, size), at == 0) for at in range(0, size, step)]
        got = [r["line"] for p in ranges for b in reader.read(p) for r in b.to_pylist()]
        assert got == lines, step


def test_max_bytes_takes_a_line_at_least_and_missing_files_fail(tmp_path):
    log = f"{tmp_path}/a.log"
    append(log, "x" * 200_000, "y")
    reader, offset = TailReader({"path": log, "max_bytes": "10"}), {}
    ends = []
    for _ in range(3):
        end = reader.latestOffset()
        reader.partitions(offset, end)
        offset = end
        ends.append(sum(end.values()))
    assert ends == [200_001, 200_003, 200_003]
    os.remove(log)
    with pytest.raises(FileNotFoundError):
        list(reader.read(LineRange("0", 0, 1, True)))
    assert reader.latestOffset() == offset
