"""Substring de-duplication: an FM-index for each shard, matching statistics of streamed passages.

A *window* is ``WINDOW`` words. Shards are cut by content: the minimizer of a window is the least hash of its
``GRAM``-word n-grams, so equal windows have equal minimizers. A minimizer found in one document only can't belong to a
repeated window; the others are owned by the smallest document that has them, their *leader*. Stretches of windows with one leader
are the passages that the leader's shard indexes and streams: all windows that might be equal meet there, and unique text goes nowhere. A leader whose passages are
more than a shard holds is split by its minimizers, and a minimizer that is itself too much by the windows. Equal passages are one unit with the
smallest document of theirs, however many documents hold them; a document finds its units again by their hash.

The index answers, for every window of a unit, which smallest document holds it: the window repeats if that
document is smaller than the one at hand. All of it is exact up to collisions of the hashes: 128 bits for units, 64 for
n-grams, and ``CODE_BYTES`` bytes for a word inside of otherwise equal windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from docweave.llm.fm_index import FMIndex
from docweave.llm.words import chunks, hashed_words, rolling, text_chunks
from docweave.session import fresh_dir, materialize

WINDOW = 13
GRAM = 5
SHARD_WORDS = 300_000
UNIT_WINDOWS = 200
CODE_BYTES = 5
MOST_WORDS = 4 * SHARD_WORDS  # of one minimizer before its equal passages are joined
_WORDS_A_MINIMIZER = 5


def minimizers(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every window inside one text: its first word's place and its minimizer."""
    grams = rolling(codes, GRAM)
    reach = WINDOW - GRAM + 1
    if len(grams) < reach:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    least, span = grams, 1
    while span * 2 <= reach:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < reach:
        rest = reach - span
        least = np.minimum(least[:-rest], least[rest:])
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    where = np.flatnonzero(owner[: len(codes) - WINDOW + 1] == owner[WINDOW - 1 :])
    return where, least[where]


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, gram): the minimizers of each text."""
    for batch in batches:
        ids = batch.column("doc_id").to_numpy()
        for first, texts in text_chunks(batch, "text"):
            codes, starts = hashed_words(texts)
            where, least = minimizers(codes, starts)
            owner = np.searchsorted(starts, where, side="right") - 1
            new = np.ones(len(where), bool)
            new[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
            yield pa.record_batch(
                [pa.array(ids[first + owner[new]]), pa.array(least[new].view(np.int64))], names=["doc_id", "gram"]
            )


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one: they travel and are stored at half the size."""
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        for first, texts in text_chunks(batch, "text"):
            packed = [None if t is None else pack.compress(t) for t in texts]
            yield pa.record_batch(
                [batch.column("doc_id").slice(first, len(texts)), pa.array(packed, pa.binary())], names=["doc_id", "packed"]
            )


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes | None]]]:
    """(first row, texts) of the chunks of a batch."""
    unpack = zstandard.ZstdDecompressor()
    packed = batch.column("packed").to_pylist()
    for start, end in chunks([2 * len(p or b"") for p in packed]):
        yield start, [None if p is None else unpack.decompress(p) for p in packed[start:end]]


def _sort_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Finished results of texts without a shared minimizer; the others keep their text."""
    for batch in batches:
        marked = batch.column("marks").is_valid()
        for first, texts in _unpacked(batch):
            open_ = marked.slice(first, len(texts)).to_pylist()
            counts, kept = [], []
            packed = batch.column("packed").slice(first, len(texts)).to_pylist()
            rest = [p if again else None for p, again in zip(packed, open_)]
            for text, again in zip(texts, open_):
                words = text.split() if text else []
                counts.append(len(words))
                kept.append(None if again else sha256(b" ".join(words)).hexdigest())
            yield pa.record_batch(
                [
                    batch.column("doc_id").slice(first, len(texts)),
                    pa.array(counts, pa.int64()),
                    pa.array(kept, pa.string()),
                    pa.array(rest, pa.binary()),
                    batch.column("marks").slice(first, len(texts)),
                ],
                names=["doc_id", "n_words", "kept_sha256", "packed", "marks"],
            )


_MARKS = "array<struct<gram: long, leader: long, level: int>>"
_UNITS = "doc_id long, start long, shard_key long, u1 long, u2 long, codes binary"


def _unit(codes: np.ndarray) -> tuple[int, int, bytes]:
    mark = blake2b(codes.tobytes(), digest_size=16).digest()
    return (*np.frombuffer(mark, np.int64).tolist(), codes.view(np.uint8).reshape(-1, 8)[:, :CODE_BYTES].tobytes())


def _codes(raw: bytes) -> np.ndarray:
    """The low ``CODE_BYTES`` bytes of the word codes of a unit."""
    full = np.zeros((len(raw) // CODE_BYTES, 8), np.uint8)
    full[:, :CODE_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, CODE_BYTES)
    return full.view(np.uint64).ravel()


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Units of texts with shared minimizers: stretches of windows with one leader, or, if that is hot, with one
    minimizer, or single windows if that is hot too."""
    for batch in batches:
        ids = batch.column("doc_id").to_numpy()
        for first, texts in _unpacked(batch):
            # who leads a minimizer is the same for every text, so the marks of a chunk are one table
            marks = batch.column("marks").slice(first, len(texts)).flatten()
            grams, leaders, levels = (marks.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            grams, place = np.unique(grams, return_index=True)
            codes, starts = hashed_words(texts)
            where, least = minimizers(codes, starts)
            signed = least.view(np.int64)
            at = np.minimum(np.searchsorted(grams, signed), len(grams) - 1)
            hit = grams[at] == signed
            where, found = where[hit], place[at[hit]]
            level = levels[found]
            key = np.where(level == 0, leaders[found], grams[at[hit]])
            new = np.ones(len(where), bool)
            new[1:] = (where[1:] != where[:-1] + 1) | (key[1:] != key[:-1]) | (level[1:] != level[:-1])
            begins = np.flatnonzero(new)
            owner = np.searchsorted(starts, where, side="right") - 1
            rows = []
            for a, b in zip(begins.tolist(), np.append(begins[1:], len(where)).tolist()):
                alone, doc, base = level[a] == 2, int(ids[first + owner[a]]), int(starts[owner[a]])
                step = 1 if alone else UNIT_WINDOWS
                for s in range(a, b, step):
                    start, count = int(where[s]), min(step, b - s)
                    k1, k2, raw = _unit(codes[start : start + count + WINDOW - 1])
                    rows.append((doc, start - base, k1 if alone else int(key[s]), k1, k2, raw))
            columns = list(zip(*rows)) if rows else [()] * 6
            yield pa.record_batch(
                [*[pa.array(c, pa.int64()) for c in columns[:5]], pa.array(columns[5], pa.binary())],
                names=["doc_id", "start", "shard_key", "u1", "u2", "codes"],
            )


def _shard(table: pa.Table) -> pa.Table:
    """For every unit the smallest document of each of its windows, as (document, windows) runs, and the least of all."""
    units = [_codes(c) for c in table.column("codes").to_pylist()]
    index = FMIndex(units, WINDOW)
    owners = index.least_owner(table.column("doc").to_numpy())
    runs, least = [], []
    for groups in index.groups_of_windows():
        docs = owners[groups]
        edges = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
        counts = np.diff(np.append(edges, len(docs)))
        runs.append(np.stack([docs[edges], counts]).astype(np.int64).tobytes())
        least.append(int(docs.min()))
    return pa.table(
        {"u1": table.column("u1"), "u2": table.column("u2"), "least": pa.array(least, pa.int64()), "runs": pa.array(runs, pa.binary())}
    )


def _take_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans, ids = batch.column("spans").to_pylist(), batch.column("doc_id").to_pylist()
        for first, texts in _unpacked(batch):
            removed, kept = [], []
            for i, text in enumerate(texts, first):
                words = text.split() if text else []
                marks = np.zeros(len(words) + 1, np.int64)
                for unit in spans[i] or ():
                    docs, counts = np.frombuffer(unit["runs"], np.int64).reshape(2, -1)
                    ends = unit["start"] + np.cumsum(counts)
                    again = docs < ids[i]
                    np.add.at(marks, (ends - counts)[again], 1)
                    np.add.at(marks, ends[again] + WINDOW - 1, -1)
                gone = np.cumsum(marks[:-1]) > 0
                removed.append(int(gone.sum()))
                kept.append(b" ".join(w for w, g in zip(words, gone.tolist()) if not g))
            yield pa.record_batch(
                [
                    batch.column("doc_id").slice(first, len(texts)),
                    batch.column("n_words").slice(first, len(texts)),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )


def _marked(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_words, kept_sha256, packed, marks): the last two only where a minimizer is shared. Bucketed and plain."""
    with_id = documents.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    prints = materialize(with_id.mapInArrow(_fingerprints, "doc_id long, gram long"), "minimizers")
    shared = prints.groupBy("gram").agg(
        F.min("doc_id").alias("leader"), F.count(F.lit(1)).alias("n")
    )
    # found twice, mostly in two documents; where one document repeats itself its windows find no smaller one
    shared = materialize(shared.filter("n > 1"), "shared-minimizers")
    loads = shared.groupBy("leader").agg(F.sum("n").alias("load"))
    hot = loads.filter(F.col("load") * _WORDS_A_MINIMIZER > SHARD_WORDS).select("leader", F.lit(True).alias("hot"))
    too_much = F.col("n") * (_WORDS_A_MINIMIZER + WINDOW - 1) > MOST_WORDS
    level = F.when(F.col("hot").isNull(), 0).when(too_much, 2).otherwise(1)
    owned = shared.join(hot, "leader", "left").select("gram", "leader", level.alias("level"))
    # both sides of these joins grow with the input: merge joins at every size, split by adaptive execution where skewed
    marks = prints.join(owned.hint("merge"), "gram").groupBy(F.col("doc_id").alias("_doc")).agg(
        F.collect_set(F.struct("gram", "leader", "level")).alias("marks")  # at most the minimizers of one text
    )
    packed = documents.mapInArrow(_pack, "doc_id long, packed binary")
    joined = packed.join(marks.hint("merge"), F.col("doc_id") == F.col("_doc"), "left").select("doc_id", "packed", "marks")
    schema = f"doc_id long, n_words long, kept_sha256 string, packed binary, marks {_MARKS}"
    return _by_document(joined.mapInArrow(_sort_out, schema))


def _by_document(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows stored once: as a table bucketed by document, whose texts a later join doesn't shuffle, and as plain files."""
    spark = rows.sparkSession
    path = fresh_dir(spark, "substring-marks")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.write.bucketBy(buckets, "doc_id").option("path", path).saveAsTable(name)
    return spark.table(name), spark.read.schema(rows.schema).parquet(path)


def repeated_units(marked: DataFrame) -> DataFrame:
    """(doc_id, start, runs): the units with a window that a smaller document holds too."""
    open_ = marked.filter("marks is not null")
    units = materialize(open_.select("doc_id", "packed", "marks").mapInArrow(_passages, _UNITS), "substring-units")
    distinct = units.groupBy("u1", "u2", "shard_key").agg(F.min("doc_id").alias("doc"), F.first("codes").alias("codes"))
    size = units.agg(F.sum(F.octet_length("codes").cast("long"))).first()[0] or 0
    shards = max(1, int(size // CODE_BYTES // SHARD_WORDS) + 1)
    shard = F.pmod(F.xxhash64("shard_key"), F.lit(shards)).alias("shard")
    found = distinct.select("u1", "u2", "doc", "codes", shard).groupBy("shard").applyInArrow(_shard, "u1 long, u2 long, least long, runs binary")
    found = materialize(found, "substring-minima")
    refs = units.select("doc_id", "start", "u1", "u2").join(found.hint("merge"), ["u1", "u2"])
    return refs.filter("least < doc_id").select("doc_id", "start", "runs")


def remove_repeats(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, and ``kept``, the words left joined by blanks (null: see below).

    Words under a window that also starts in a document with a smaller id are removed; windows are judged on the
    input. A null text has no words. A row without id is compared with nothing. Rows that repeat an id are one document. For
    texts that share nothing ``kept`` is null and ``kept_sha256`` has the hash of all their words. An empty table
    gives an empty result.
    """
    bucketed, marked = _marked(documents.select("doc_id", "text"))
    spans = repeated_units(marked)
    spans = spans.groupBy(F.col("doc_id").alias("_doc")).agg(F.collect_list(F.struct("start", "runs")).alias("spans"))
    open_ = bucketed.filter("marks is not null").select("doc_id", "n_words", "packed")
    cut = open_.join(spans.hint("merge"), F.col("doc_id") == F.col("_doc"), "left").select("doc_id", "n_words", "packed", "spans")
    cut = cut.mapInArrow(_take_out, "doc_id long, n_words long, n_removed long, kept string")
    cut = cut.withColumn("kept_sha256", F.sha2("kept", 256))
    whole = marked.filter("marks is null").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.lit(None).cast("string").alias("kept"), "kept_sha256"
    )
    return whole.unionByName(cut)


def substring_digest(documents: DataFrame) -> DataFrame:
    """The result with a hash in place of the words."""
    return remove_repeats(documents).drop("kept")
