"""Find benchmark items in documents by edit distance.

Texts and items are sequences of word codes. A document leaks an item when one of its windows reaches an edit
similarity of ``SIMILARITY`` with it: at most ``k = floor((1 - SIMILARITY) * words)`` word edits. Items
of fewer than five words allow none and are found where they stand word for word.

The CGK embedding (Chakraborty, Goldenberg, Koucky, 2016) walks through a sequence and repeats its current
symbol or goes on, as a random function of step and symbol says; two sequences that share the function and are k
edits apart come out at a Hamming distance of about k squared, however the edits shift them. Bit sampling
turns that into buckets: a table keeps ``SAMPLE`` positions of one walk, and a window collides with an item when
all agree. Tables are repeated, each with a walk of its own, until ``TABLES`` of them make the recall (see the tests: above 0.99
at the full number of edits).

Walks fall out of step over long sequences, so items are embedded as segments of at most ``SEGMENT`` words. Edits that are within the
item's share can't exceed the share of each segment, so one segment at least is as near to its part of the text as an item of its
length must be, and finding it is enough: the whole item is verified around it.

Windows are segment-sized and start where they can: k edits leave some run of ``ceil((n - k) / (k + 1))``
of the segment's ``n`` words intact, so a window near a segment holds one of its runs of ``q`` words, ``q`` being the smaller
of that and ``RUN``; the offset of the run in the segment gives the window's place up to k words, and the aligned window is
embedded. The item around a colliding window is verified by exact semi-global edit distance, which also finds where
the leaked passage begins and ends.

Items are broadcast in slices of at most ``SLICE_WORDS`` words; more items mean more passes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from docweave.llm.words import WordCache, mix, rolling, split_words, text_chunks, word_code
from docweave.session import materialize

SIMILARITY_PERCENT = 80
RUN = 3
TABLES = 24
SAMPLE = 3
SEGMENT = 32
SLICE_WORDS = 2_000_000
_EMBED_CELLS = 1 << 21
_SIEVE_BITS = 20
_EDGES = " \t\n\r\x0b\x0c.,;:!?\"'()[]{}|*$%&#<>"


def normal_word(word: bytes) -> int:
    """Code of a word without case and the punctuation around it; 0 if nothing is left."""
    bare = word.decode().strip(_EDGES).lower()
    return word_code(bare.encode()) if bare else 0


def item_words(texts: list[bytes | None], cache: WordCache) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word codes of texts without empty words, where each text begins, and each word's number in its text."""
    words, starts = split_words(texts)
    codes = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    number = np.arange(len(codes)) - np.repeat(starts[:-1], np.diff(starts))
    real = codes != 0
    kept = np.concatenate([[0], np.cumsum(real)])
    return codes[real], kept[starts], number[real]


def allowed(n: int, percent: int = SIMILARITY_PERCENT) -> int:
    """Word edits that an item of ``n`` words may be away."""
    return n * (100 - percent) // 100


def run_length(n: int, percent: int = SIMILARITY_PERCENT) -> int:
    """Words of a run that the edits must leave intact, at most ``RUN``."""
    k = allowed(n, percent)
    return min(RUN, -(-(n - k) // (k + 1)))


def embed(windows: np.ndarray, lengths: np.ndarray, tables: int = TABLES, sample: int = SAMPLE) -> np.ndarray:
    """Bucket codes (rows x tables) of padded word windows by CGK walks and bit sampling.

    A walk over n words has 2n steps of interest; the sampled positions are shares of that length, so
    windows of one length agree on them.
    """
    rows = len(windows)
    out = np.zeros((rows, tables), np.uint64)
    everyone = np.arange(rows)
    steps = int(2 * lengths.max()) if rows else 0
    padded = np.concatenate([windows, np.zeros((rows, 1), np.uint64)], axis=1)
    rng = np.random.default_rng(7)
    shares = np.sort(rng.random((tables, sample)), axis=1)
    for t in range(tables):
        at = np.zeros(rows, np.int64)
        wanted = (shares[t][:, None] * (2 * lengths)[None, :]).astype(np.int64)
        for step in range(steps):
            symbol = padded[everyone, at]
            for s in range(sample):
                hit = wanted[s] == step
                out[hit, t] = mix(out[hit, t] * np.uint64(31) + symbol[hit] + np.uint64(s + 1))
            go = mix(symbol + np.uint64(t * 1_000_003 + step * 7919 + 1)) & np.uint64(1)
            at = np.minimum(at + go.astype(np.int64), lengths)
    return out


def best_passage(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(edits, begin, end) of the part of ``text`` nearest to ``item``, by word edit distance.

    Of equally near parts the first end and the longest part count.
    """
    n = len(text)
    cost, begin = np.zeros(n + 1, np.int64), np.arange(n + 1)
    ramp = np.arange(n + 1)
    for i, word in enumerate(item, 1):
        up = cost + 1
        diagonal = np.concatenate([[i], cost[:-1] + (text != word)])
        from_diagonal = np.concatenate([[0], begin[:-1]])
        step = np.minimum(up, diagonal)
        origin = np.where(diagonal <= up, from_diagonal, begin)
        # along a row each step to the right costs one: a running minimum of cost - position
        slid = step - ramp
        least = np.minimum.accumulate(slid)
        first = np.maximum.accumulate(np.where(slid == least, ramp, 0))
        cost, begin = least + ramp, origin[first]
    end = int(cost.argmin())
    return int(cost[end]), int(begin[end]), end


class ItemIndex:
    """Runs and bucket codes of the segments of a slice of benchmark items."""

    def __init__(self, ids: list, texts: list[bytes | None], percent: int = SIMILARITY_PERCENT):
        codes, starts, _ = item_words(texts, WordCache(normal_word))
        found = [(i, codes[a:b]) for i, a, b in zip(ids, starts[:-1], starts[1:]) if b > a]
        self.percent = percent
        self.ids = [i for i, _ in found]
        self.words = [w for _, w in found]
        cuts = [np.linspace(0, len(w), -(-len(w) // SEGMENT) + 1).astype(np.int64) for w in self.words]
        self.owner = np.repeat(np.arange(len(found)), [len(c) - 1 for c in cuts])  # item of each segment
        self.offsets = np.array([a for c in cuts for a in c[:-1]], np.int64)
        segments = [w[a:b] for w, c in zip(self.words, cuts) for a, b in zip(c[:-1], c[1:])]
        self.lengths = np.array([len(w) for w in segments], np.int64)
        self.edits = np.array([allowed(len(w), percent) for w in self.words], np.int64)
        self.runs: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.maybe: dict[int, np.ndarray] = {}  # a sieve in front of the search among the runs
        by_length: dict[int, list] = {}
        for segment, words in enumerate(segments):
            q = run_length(len(words), percent)
            for offset, h in enumerate(rolling(words, q)):
                by_length.setdefault(q, []).append((h, segment, offset))
        for q, rows in by_length.items():
            hashes = np.array([r[0] for r in rows], np.uint64)
            order = np.argsort(hashes, kind="stable")
            place = np.array([r[1:] for r in rows], np.int64).reshape(-1, 2)[order]
            self.runs[q] = hashes[order], place[:, 0], place[:, 1]
            self.maybe[q] = np.zeros(1 << _SIEVE_BITS, bool)
            self.maybe[q][hashes >> np.uint64(64 - _SIEVE_BITS)] = True
        width = int(self.lengths.max()) if len(found) else 0
        padded = np.zeros((len(segments), width), np.uint64)
        for row, words in zip(padded, segments):
            row[: len(words)] = words
        self.buckets = embed(padded, self.lengths)

    def windows(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Distinct (text, segment, begin) of the segment-sized windows that hold a run of the segment in its place."""
        found = []
        owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        for q, (hashes, segments, offsets) in self.runs.items():
            grams = rolling(codes, q)
            hit = np.flatnonzero(self.maybe[q][grams >> np.uint64(64 - _SIEVE_BITS)])
            hit = hit[owner[hit] == owner[hit + q - 1]]
            lo = np.searchsorted(hashes, grams[hit])
            same = hashes[np.minimum(lo, len(hashes) - 1)] == grams[hit]
            hit, lo = hit[same], lo[same]
            hi = np.searchsorted(hashes, grams[hit], side="right")
            many = hi - lo
            entry = np.repeat(lo, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            at = np.repeat(hit, many)
            found.append(np.stack([owner[at], segments[entry], at - offsets[entry]], axis=1))
        return np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 3), np.int64)

    def search(self, codes: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(text, item, edits, begin, end) of leaked passages, the best of each text and item and place."""
        windows = self.windows(codes, starts)
        near = []
        width = int(self.lengths.max()) if len(self.ids) else 0
        step = max(1, _EMBED_CELLS // max(1, width * 8))
        for a in range(0, len(windows), step):
            text, segment, begin = windows[a : a + step].T
            lo, n = starts[text], self.lengths[segment]
            at = begin[:, None] + np.arange(width)[None, :]
            inside = (at >= lo[:, None]) & (at < np.minimum(starts[text + 1], begin + n)[:, None])
            cut = np.where(inside, codes[np.clip(at, 0, len(codes) - 1)], np.uint64(0))
            met = (embed(cut, n) == self.buckets[segment]).any(axis=1)
            near.append(np.stack([text, self.owner[segment], begin - self.offsets[segment]], axis=1)[met])
        out: dict[tuple[int, int, int], tuple] = {}
        if near:
            for t, i, b in np.unique(np.concatenate(near), axis=0).tolist():
                k = int(self.edits[i])
                left, right = max(int(starts[t]), b - k), min(int(starts[t + 1]), b + len(self.words[i]) + k)
                edits, x, y = best_passage(self.words[i], codes[left:right])
                if edits <= k:
                    key = (t, i, left + y)
                    out[key] = min(out.get(key, (edits, left + x, left + y)), (edits, left + x, left + y))
        return [(t, i, *best) for (t, i, _), best in sorted(out.items())]


def _scan(shared):
    columns = ["doc_id", "item_id", "edits", "begin", "end"]
    schema = pa.schema([(c, pa.int64()) for c in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, cache = shared.value, WordCache(normal_word)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for first, texts in text_chunks(batch, "text"):
                codes, starts, number = item_words(texts, cache)
                rows = [
                    (ids[first + t], index.ids[i], edits, int(number[a]), int(number[b - 1]) + 1)
                    for t, i, edits, a, b in index.search(codes, starts)
                    if b > a
                ]
                yield pa.record_batch([pa.array([r[c] for r in rows], pa.int64()) for c in range(5)], schema=schema)

    return run, ", ".join(f"{c} long" for c in columns)


def _slices(benchmark: DataFrame, slice_words: int) -> Iterator[tuple[list, list[bytes | None]]]:
    """(ids, texts) of the items, in slices of bounded size; a slice is collected after it is measured."""
    items = benchmark.select("item_id", "text").filter(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    bytes_ = F.octet_length("text").cast("long")
    total = items.agg(F.sum(bytes_)).first()[0] or 0
    number = int(total // (slice_words * 6)) + 1
    for part in range(number):
        mine = items if number == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(number)) == part)
        rows = mine.collect()
        yield [r["item_id"] for r in rows], [r["text"].encode() for r in rows]


def find_leaks(documents: DataFrame, benchmark: DataFrame, slice_words: int = SLICE_WORDS) -> DataFrame:
    """(doc_id, item_id, edits, begin, end): leaked passages as word positions, end exclusive.

    Case and punctuation at word ends don't count. A null text or item, and an item without id, leaks nothing. Documents of
    repeated rows report each passage once; a document without id reports it under a null id. Items with
    equal texts are all reported. Without documents or items the result is empty.
    """
    slim = documents.select("doc_id", "text")
    found = None
    for ids, texts in _slices(benchmark, slice_words):
        shared = slim.sparkSession.sparkContext.broadcast(ItemIndex(ids, texts))
        run, schema = _scan(shared)
        part = slim.mapInArrow(run, schema)
        found = part if found is None else found.union(part)
    best = Window.partitionBy("doc_id", "item_id", "end").orderBy("edits", "begin")
    found = found.withColumn("_best", F.row_number().over(best)).filter("_best = 1").drop("_best")
    return found


def leak_report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``documents``: doc_id, ``leaked``, the items found (ascending), and passages as ``item:begin:end``."""
    found = materialize(find_leaks(documents, benchmark), "leaks")
    span = F.concat_ws(":", "item_id", "begin", "end")
    per_document = found.filter("doc_id is not null").groupBy(F.col("doc_id").alias("_doc")).agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("begin", "end", "item_id", span.alias("s")))), lambda x: x["s"]), ",").alias("passages"),
        F.count(F.lit(1)).alias("n_passages"),
    )
    slim = documents.select("doc_id")
    return slim.join(per_document, F.col("doc_id") == F.col("_doc"), "left").select(
        "doc_id",
        F.col("_doc").isNotNull().alias("leaked"),
        F.coalesce("n_passages", F.lit(0)).alias("n_passages"),
        F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"),
        F.coalesce("passages", F.lit("")).alias("passages"),
    )


def drop_leaking(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that leak no item, all columns; rows without id stay."""
    leaking = find_leaks(documents, benchmark).select(F.col("doc_id").alias("_leaking")).filter("_leaking is not null").distinct()
    return documents.join(leaking, F.col("doc_id") == F.col("_leaking"), "left_anti")
