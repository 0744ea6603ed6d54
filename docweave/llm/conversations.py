"""Repair the structure of conversations by the cheapest edits, with a grammar over their role and fault sequences.

A conversation's rows, by turn (nulls first, then role and text), are judged - blank, seen earlier, truncated or fine - and
written as *segments*: up to ``SEGMENT_ROWS`` rows, or ``SEGMENT_CHARS`` characters, as one string of symbols (see
``edit_algebra``). Spark counts the pairs of symbols over the distinct segments of all conversations, and the most frequent become Re-Pair
rules, a round at a time. One matrix for each rule is then evaluated from those of its two parts and used for all conversations.

A conversation may be of any size. Equal rows are counted before the shuffle, earlier copies are found by aggregation, and
rows are range-partitioned by conversation and place, so a long one is spread over tasks. Its parts are matrices that are multiplied
partition by partition and then once for each conversation; only this last product, its audit and the hash of its text
(which reads texts in order, a segment at a time) are work of one task for each conversation, as they are one value each.

Defined results: a null role or text is one space; a role that starts with none of ``s``, ``u``, ``a``, an empty one among them, can't be kept. Rows
of equal turn are ordered by role and text. Equal rows count once each, all but the first as duplicates. A null conversation id is an
id of its own. Conversations without rows have zeros, an empty audit and the hash of the empty string. ``gaps`` is null where it does not
fit 64 bits. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from docweave.llm import edit_algebra as ea
from docweave.session import materialize

SEGMENT_ROWS = 1024
SEGMENT_CHARS = 1 << 20
ROUNDS = 8
RULES_A_ROUND = 32
PREFIX = 64
BLANKS = " \t\n\v\f\r"
FAULTS = (None, "blank", "duplicate", "truncated")


def _known(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows damaged by a checksum of their place; ``copies`` is 0 for a dropped row."""
    code = F.crc32(F.concat(_known("conv_id"), F.lit(":"), _known("turn"))) % 20
    rows = conversations.select("conv_id", "turn", _known("role").alias("role"), _known("text").alias("text"), code.alias("code"))
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.when(F.col("code") == 0, 0).when(F.col("code") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _distinct_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies, again): each different row once; ``again`` if an earlier turn has its role and text."""
    present = rows.filter("copies > 0").withColumn(
        "print", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    )
    first = (
        present.groupBy("conv_id", "print")
        .agg(
            F.min("turn").alias("_first"),
            F.max("turn").alias("_last"),
            F.max(F.col("turn").isNull()).alias("_null"),
        )
        .filter("_first < _last OR (_null AND _first IS NOT NULL)")
        .select(F.col("conv_id").alias("_conv"), F.col("print").alias("_print"), "_first", "_null")
    )
    each = present.groupBy("conv_id", "turn", "role", "text", "print").agg(F.sum("copies").alias("copies"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("print") == F.col("_print"))
    later = F.col("turn").isNotNull() & (F.col("_null") | (F.col("turn") > F.col("_first")))
    return each.join(first, same, "left").select(
        "conv_id", "turn", "role", "text", "copies", F.coalesce(later, F.lit(False)).alias("again")
    )


_SEGMENT = (
    "conv_id long, part int, seq long, whole boolean, symbols string, roles array<string>, texts array<string>"
)
_STRINGS = pa.list_(pa.string())


def _signs(role: str, text: str, copies: int, again: bool) -> Iterator[tuple[str, bool]]:
    """(symbol, whether its row can stay) of the copies of a row."""
    body = text.rstrip(BLANKS)
    fault = ea.BLANK if not body else ea.DUPLICATE if again else ea.FINE if body[-1] in ".!?" else ea.TRUNCATED
    yield ea.symbol(role, fault), fault in (ea.FINE, ea.TRUNCATED)
    rest = ea.symbol(role, ea.DUPLICATE if body else ea.BLANK)
    for _ in range(copies - 1):
        yield rest, False


def _segment_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of sorted rows. A conversation at either end of the partition may go on in another one."""
    part = TaskContext.get().partitionId()
    out: list[tuple] = []  # finished segments
    begun = False  # whether a conversation has been begun
    conv, opening, pieces, seq = None, True, 0, 0  # the current one; is it the first; its closed segments; segments so far
    symbols, roles, texts, chars = [], [], [], 0

    def close(whole: bool) -> None:
        nonlocal symbols, roles, texts, chars, seq, pieces
        out.append((conv, part, seq, whole, "".join(symbols), roles, texts))
        symbols, roles, texts, chars = [], [], [], 0
        seq += 1
        pieces += 1

    def batch_of() -> pa.RecordBatch:
        nonlocal out
        columns = list(zip(*out))
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.string(), _STRINGS, _STRINGS)
        names = ("conv_id", "part", "seq", "whole", "symbols", "roles", "texts")
        made = pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
        out = []
        return made

    size = 0
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("conv_id", "role", "text", "copies", "again")]
        for conv_id, role, text, copies, again in zip(*columns):
            if not begun or conv_id != conv:
                if begun:
                    close(whole=not opening and not pieces)
                    opening = False
                begun, conv, pieces = True, conv_id, 0
            for sign, stays in _signs(role, text, copies, again):
                if len(symbols) == SEGMENT_ROWS or chars > SEGMENT_CHARS:
                    close(whole=False)
                symbols.append(sign)
                if stays:
                    roles.append(role)
                    texts.append(text)
                    chars += len(text)
                    size += len(text)
                if len(out) >= 4096 or size > 4 * SEGMENT_CHARS:
                    size = 0
                    if out:
                        yield batch_of()
    if begun:
        close(whole=False)
        yield batch_of()


def segments(rows: DataFrame) -> DataFrame:
    """Segments of judged rows, written once."""
    prefix = F.substring("text", 1, PREFIX)  # orders as the text does, and keeps the bounds of the ranges small
    ranged = _distinct_rows(rows).repartitionByRange("conv_id", "turn", "role", prefix)
    ordered = ranged.sortWithinPartitions("conv_id", "turn", "role", "text")
    return materialize(ordered.mapInArrow(_segment_task, _SEGMENT), "conversation-segments")


def _count_task(rules: list[str]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        algebra = ea.Algebra(rules)
        counts = ea.Counter()
        for batch in batches:
            counts += ea.pair_counts(algebra, zip(batch.column("symbols").to_pylist(), batch.column("n").to_pylist()))
        yield pa.record_batch([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["pair", "n"])

    return task


def learn_rules(parts: DataFrame, rounds: int = ROUNDS, a_round: int = RULES_A_ROUND) -> list[str]:
    """Re-Pair rules, in order, from the symbol pairs of all segments; at most ``rounds * a_round``.

    A round counts the pairs of the shortened distinct segments, weighted by how often each occurs, and adds
    the most frequent ones that occur twice. Pairs are bounded by the square of the symbols and rules.
    """
    distinct = materialize(parts.groupBy("symbols").agg(F.count(F.lit(1)).alias("n")), "conversation-sequences")
    rules: list[str] = []
    for _ in range(rounds):
        counts = distinct.mapInArrow(_count_task(rules), "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        best = counts.filter("n > 1").orderBy(F.desc("n"), "pair").limit(a_round).collect()
        if not best:
            break
        rules += [r["pair"] for r in best]
    return rules


def _counts(symbols: str) -> tuple[int, int, int, int]:
    """(blank, duplicate, truncated, illegal) of a stretch of rows."""
    faults = [0, 0, 0, 0]
    for sign, n in ea.Counter(symbols).items():
        faults[ea.fault_of(sign)] += n
    kinds = [ea.class_of(s) for s in symbols]
    return *faults[1:], sum((a, b) not in _LEGAL for a, b in zip(kinds, kinds[1:]))


_LEGAL = {(0, 1), (1, 2), (2, 1)}


def repaired(symbols: str, roles: list[str], texts: list[str], audit: str, before: int, led: bool) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the rows that a stretch keeps, turns into another role or gains.

    ``before`` rows of the repaired conversation come earlier; ``led`` if it starts with a system row.
    """
    rows, place, out = iter(zip(roles, texts)), 0, before
    for edit in audit:
        due = ("user", "assistant")[(out - led) % 2]
        if edit == "I":
            yield edit, due, ""
            out += 1
            continue
        role, text = next(rows) if ea.fault_of(symbols[place]) in (ea.FINE, ea.TRUNCATED) else (None, None)
        place += 1
        if edit != "D":
            yield edit, role if edit == "K" else due, text
            out += 1


def _is_led(audit: str) -> bool:
    """Whether a repaired conversation starts with a system row: pairs follow it, so its length is odd."""
    return (len(audit) - audit.count("D")) % 2 == 1


_REPORT = "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _whole_task(rules: list[str]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        algebra = ea.Algebra(rules)
        known: dict[str, tuple] = {}
        for batch in batches:
            made = []
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "symbols", "roles", "texts")]
            for conv_id, symbols, roles, texts in zip(*columns):
                if symbols not in known:
                    if len(known) >= 1 << 16:
                        known.clear()
                    known[symbols] = (*_counts(symbols), *algebra.cheapest(symbols))
                found = known[symbols]
                audit = found[-1]
                lines = "\n".join(f"{role}:{text}" for _, role, text in repaired(symbols, roles, texts, audit, 0, _is_led(audit)))
                made.append((conv_id, *found, hashlib.sha256(lines.encode()).hexdigest()))
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            names = [c.split()[0] for c in _REPORT.split(", ")]
            columns = list(zip(*made)) or [[]] * len(names)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return task


_PART = (
    "conv_id long, part int, seq long, blank long, duplicate long, truncated long, illegal long, first string, last string, "
    "costs array<long>, audits array<string>, pieces array<struct<part: int, seq: long, rows: long>>"
)
_PIECES = pa.list_(pa.struct([("part", pa.int32()), ("seq", pa.int64()), ("rows", pa.int64())]))
_PART_SCHEMA = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("part", pa.int32()),
        ("seq", pa.int64()),
        *[(n, pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal")],
        ("first", pa.string()),
        ("last", pa.string()),
        ("costs", pa.list_(pa.int64())),
        ("audits", _STRINGS),
        ("pieces", _PIECES),
    ]
)


def _matrix_task(rules: list[str]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        algebra = ea.Algebra(rules)
        for batch in batches:
            made = []
            for conv_id, part, seq, symbols in zip(*[batch.column(n).to_pylist() for n in ("conv_id", "part", "seq", "symbols")]):
                costs, audits = algebra.matrix(symbols)
                piece = {"part": part, "seq": seq, "rows": len(symbols)}
                made.append((conv_id, part, seq, *_counts(symbols), symbols[0], symbols[-1], costs, audits, [piece]))
            if made:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*made), _PART_SCHEMA)], schema=_PART_SCHEMA)

    return task


def _fold(table: pa.Table) -> pa.Table:
    """Parts of a conversation in order, as one part."""
    rows = sorted(table.to_pylist(), key=lambda r: (r["part"], r["seq"]))
    costs, audits = ea.product([(r["costs"], r["audits"]) for r in rows])
    met = [(ea.class_of(a["last"]), ea.class_of(b["first"])) for a, b in zip(rows, rows[1:])]
    one = {
        **rows[0],
        **{n: sum(r[n] for r in rows) for n in ("blank", "duplicate", "truncated")},
        "illegal": sum(r["illegal"] for r in rows) + sum(pair not in _LEGAL for pair in met),
        "last": rows[-1]["last"],
        "costs": costs,
        "audits": audits,
        "pieces": [p for r in rows for p in r["pieces"]],
    }
    return pa.Table.from_pylist([one], schema=_PART_SCHEMA)


_ENDED = "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, pieces array<struct<part: int, seq: long, rows: long>>"


def _end_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ended = [ea.finish(m) for m in zip(batch.column("costs").to_pylist(), batch.column("audits").to_pylist())]
        names = ["conv_id", "blank", "duplicate", "truncated", "illegal"]
        yield pa.record_batch(
            [
                *[batch.column(n) for n in names],
                pa.array([c for c, _ in ended], pa.int64()),
                pa.array([a for _, a in ended], pa.string()),
                batch.column("pieces"),
            ],
            names=[*names, "cost", "audit", "pieces"],
        )


_PLAN = "part int, seq long, conv_id long, piece string, before long, led boolean"


def _cut_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The audit of a conversation, segment by segment."""
    for batch in batches:
        for conv_id, audit, pieces in zip(*[batch.column(n).to_pylist() for n in ("conv_id", "audit", "pieces")]):
            letters = np.frombuffer(audit.encode(), np.uint8)
            ends = np.flatnonzero(letters != ord("I")) + 1  # of the edits of rows
            upto = [int(ends[n - 1]) for n in np.cumsum([p["rows"] for p in pieces])]
            upto[-1] = len(audit)
            starts = [0, *upto[:-1]]
            before = np.concatenate([[0], np.cumsum(letters != ord("D"))])[starts]
            n = len(pieces)
            yield pa.record_batch(
                [
                    pa.array([p["part"] for p in pieces], pa.int32()),
                    pa.array([p["seq"] for p in pieces], pa.int64()),
                    pa.array([conv_id] * n, pa.int64()),
                    pa.array([audit[a:b] for a, b in zip(starts, upto)], pa.string()),
                    pa.array(before.astype(np.int64)),
                    pa.array([_is_led(audit)] * n),
                ],
                names=["part", "seq", "conv_id", "piece", "before", "led"],
            )


def _chunk_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repaired rows of segments as text."""
    names = ("symbols", "roles", "texts", "piece", "before", "led")
    for batch in batches:
        chunks = []
        for row in zip(*[batch.column(n).to_pylist() for n in names]):
            lines = [f"{role}:{text}" for _, role, text in repaired(*row)]
            chunks.append("\n".join(lines).encode() if lines else None)
        kept = [batch.column(n) for n in ("conv_id", "part", "seq")]
        yield pa.record_batch([*kept, pa.array(chunks, pa.binary())], names=["conv_id", "part", "seq", "chunk"])


def _hash_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the chunks of each conversation, in order, holding one chunk at a time."""
    begun, conv, state, some = False, None, None, False

    def row() -> pa.RecordBatch:
        return pa.record_batch([pa.array([conv], pa.int64()), pa.array([state.hexdigest()])], names=["conv_id", "repaired_sha256"])

    for batch in batches:
        for conv_id, chunk in zip(batch.column("conv_id").to_pylist(), batch.column("chunk").to_pylist()):
            if not begun or conv_id != conv:
                if begun:
                    yield row()
                begun, conv, state, some = True, conv_id, hashlib.sha256(), False
            if chunk is not None:
                state.update(b"\n" + chunk if some else chunk)
                some = True
    if begun:
        yield row()


def _split_report(parts: DataFrame, rules: list[str]) -> DataFrame:
    """Report of conversations that lie in several segments or at the end of a partition."""
    split = parts.filter("NOT whole")
    matrices = split.select("conv_id", "part", "seq", "symbols").mapInArrow(_matrix_task(rules), _PART)
    by_part = matrices.groupBy("conv_id", "part").applyInArrow(_fold, _PART)  # as many segments as a partition holds
    joined = by_part.groupBy("conv_id").applyInArrow(_fold, _PART)  # a row for each partition
    ended = materialize(joined.mapInArrow(_end_task, _ENDED), "conversation-ends")
    plan = ended.select("conv_id", "audit", "pieces").mapInArrow(_cut_task, _PLAN)
    rows = split.select("part", "seq", "symbols", "roles", "texts").join(plan, ["part", "seq"])
    chunks = rows.mapInArrow(_chunk_task, "conv_id long, part int, seq long, chunk binary")
    order = ("conv_id", "part", "seq")
    hashes = chunks.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_hash_task, "conv_id long, repaired_sha256 string")
    hashes = hashes.withColumnRenamed("conv_id", "_conv")
    same = F.col("conv_id").eqNullSafe(F.col("_conv"))
    return ended.join(hashes, same).select(*[c.split()[0] for c in _REPORT.split(", ")])


def gaps(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps) of every conversation: turns missing between its first and last."""
    turn = F.when(F.col("copies") > 0, F.col("turn"))
    wide = "decimal(20,0)"
    agg = rows.groupBy("conv_id").agg(F.min(turn).alias("a"), F.max(turn).alias("b"), F.count_distinct(turn).alias("n"))
    count = F.col("b").cast(wide) - F.col("a").cast(wide) + 1 - F.col("n")
    return agg.select("conv_id", F.when(F.col("a").isNull(), F.lit(0)).otherwise(count.try_cast("long")).cast("long").alias("gaps"))


def repair_report(rows: DataFrame) -> DataFrame:
    """One row for each conversation of (conv_id, turn, role, text, copies): faults, cost, audit and the hash of the repaired rows."""
    parts = segments(rows)
    rules = learn_rules(parts)
    whole = parts.filter("whole").select("conv_id", "symbols", "roles", "texts").mapInArrow(_whole_task(rules), _REPORT)
    report = whole.unionByName(_split_report(parts, rules)).withColumnRenamed("conv_id", "_conv")
    zero = lambda name: F.coalesce(name, F.lit(0)).alias(name)
    return (
        gaps(rows)
        .join(report, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
        .select(
            "conv_id",
            "gaps",
            *[zero(n) for n in ("blank", "duplicate", "truncated", "illegal", "cost")],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
        )
    )


def _rows_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("symbols", "roles", "texts", "piece", "before", "led")
    for batch in batches:
        made = []
        for conv_id, *row in zip(*[batch.column(n).to_pylist() for n in ("conv_id", *names)]):
            made += [(conv_id, row[4] + i, *kept) for i, kept in enumerate(repaired(*row))]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        columns = list(zip(*made)) or [[]] * len(kinds)
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["conv_id", "position", "edit", "role", "text"])


def repaired_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, position, edit, role, text): the repaired conversations themselves, positions from 0."""
    parts = segments(rows)
    rules = learn_rules(parts)
    matrices = parts.select("conv_id", "part", "seq", "symbols").mapInArrow(_matrix_task(rules), _PART)
    joined = matrices.groupBy("conv_id", "part").applyInArrow(_fold, _PART).groupBy("conv_id").applyInArrow(_fold, _PART)
    plan = joined.mapInArrow(_end_task, _ENDED).select("conv_id", "audit", "pieces").mapInArrow(_cut_task, _PLAN)
    cut = parts.select("part", "seq", "symbols", "roles", "texts").join(plan, ["part", "seq"])
    return cut.mapInArrow(_rows_task, "conv_id long, position long, edit string, role string, text string")


def rows_of(conversations: DataFrame) -> DataFrame:
    """Conversations as they are, in the form that ``repair_report`` and ``repaired_rows`` take."""
    return conversations.select(
        "conv_id", "turn", _known("role").alias("role"), _known("text").alias("text"), F.lit(1).cast("long").alias("copies")
    )
