"""Jaccard join of documents by word n-grams as a blocked sparse matrix product.

The document by n-gram incidence matrix A is never multiplied whole. Rows with the same set of n-grams
are one class. Two sets can only reach the similarity ``t`` if their prefixes, the smallest hashes of
each set in one global order, share ``need`` hashes (a bound that follows from the set sizes alone); so
only hashes found in the prefixes of two classes matter. Of these a class leaves out as many as any of its pairs
shares at least, the most frequent ones first: in one order of all hashes, the last one that a pair shares is
left out by neither. Every other hash sends its classes to the block
named by its smallest class: classes that share it share a block. A block of more than
``BLOCK_ROWS`` rows or ``BLOCK_NGRAMS`` n-grams is split into parts, and each pair of parts is one group.

Whole sets are only sent to a block for rows that are likely to have a partner in it. That is decided on sketches of a bit
or two for each n-gram: bit ``i`` tells whether an odd number of n-grams fell on place ``i``. Every place at which two sketches differ
holds an n-gram that only one of the sets has, so two sets that differ too much are told apart and no pair is missed.

Inside a group the product A x A' is made from postings: n-grams of one row only are dropped, and with
them rows that have too few left to reach any partner; overlap counts of the others are accumulated in
pieces, pairs below the size bound are discarded, and the exact test decides. A group returns the edges of a
spanning forest, at most one per row, never its pairs. All of it is exact up to collisions of 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from docweave.llm.graph import components
from docweave.llm.words import WordCache, lower_ascii, rolling, split_words, text_chunks, word_code, word_codes
from docweave.session import materialize, scratch

BLOCK_ROWS = 1024
BLOCK_NGRAMS = 2_000_000
EXTRA_PERCENT = 3
SKETCH_ROWS = 4096
SKETCH_NGRAMS = 1 << 26
_PRODUCT_CELLS = 1 << 22
_SKETCH_CELLS = 1 << 20
_SET = ["k1", "k2"]


def needed(n, percent: int):
    """Least overlap of a set of ``n`` with any partner of at least that similarity."""
    return -(-(n * percent) // 100)


def extra(n):
    """How many prefix hashes beyond the first a pair has to share."""
    return n * EXTRA_PERCENT // 100


def ngram_sets(texts: list[bytes | None], k: int, cache: WordCache) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text; a text of fewer than ``k`` words is one n-gram."""
    words, starts = split_words([lower_ascii(t) for t in texts])
    codes = word_codes(words, cache)
    hashes = rolling(codes, k)
    sets = []
    for start, end in zip(starts[:-1], starts[1:]):
        if end - start >= k:
            sets.append(np.unique(hashes[start : end - k + 1]))
        elif end > start:
            sets.append(rolling(codes[start:end], int(end - start)))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """128 bits of each set, as two rows of numbers."""
    marks = b"".join(blake2b(s.tobytes(), digest_size=16).digest() for s in sets)
    return np.ascontiguousarray(np.frombuffer(marks, np.int64).reshape(-1, 2).T)


def sketches(sets: list[np.ndarray]) -> list[bytes]:
    """Parities of the n-grams at each place, one bit a place; the number of places is the next power of two, 64 at least.

    A sketch of twice the places folds to one of half of them by an exclusive or of its halves.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    places = np.int64(64) << np.ceil(np.log2(np.maximum(sizes, 64) / 64)).astype(np.int64)
    ends = np.cumsum(places)
    if not len(sets):
        return []
    at = (np.concatenate(sets) & np.repeat(places - 1, sizes).astype(np.uint64)).astype(np.int64)
    counts = np.bincount(at + np.repeat(ends - places, sizes), minlength=ends[-1])
    bits = np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()
    return [bits[(end - n) // 8 : end // 8] for end, n in zip(ends.tolist(), places.tolist())]


def likely(sizes: np.ndarray, marks: list[bytes], side: np.ndarray, percent: int) -> np.ndarray:
    """Which rows may have a partner by their sizes and sketches; no row that has one is left out. ``side`` as for ``forest``."""
    two_sided = side.min() != side.max()
    found = np.zeros(len(sizes), bool)
    order = np.argsort(sizes, kind="stable")
    widths = np.array([len(marks[i]) // 8 for i in order])
    groups = {int(w): order[widths == w] for w in np.unique(widths)}
    tables = {w: np.frombuffer(b"".join(marks[i] for i in rows), np.uint64).reshape(-1, w) for w, rows in groups.items()}
    for w, small in groups.items():
        for v, large in groups.items():
            if v < w or 100 * sizes[small[-1]] < percent * sizes[large[0]]:
                continue
            mine, folded = tables[w], tables[v]
            while folded.shape[1] > w:
                folded = folded[:, : folded.shape[1] // 2] ^ folded[:, folded.shape[1] // 2 :]
            mine, folded = np.ascontiguousarray(mine.T), np.ascontiguousarray(folded.T)
            of_small, of_large = sizes[small], sizes[large]
            first, start = 0, 0
            while start < len(small):
                # partners of this row and the next ones: none is smaller than it is, nor too large for the last
                first = max(start, 0) if v == w else 0
                step = 1
                last = np.searchsorted(of_large, 100 * of_small[start] // percent, "right")
                while start + step < len(small):
                    more = np.searchsorted(of_large, 100 * of_small[start + step] // percent, "right")
                    if (step + 1) * (more - first) > _SKETCH_CELLS:
                        break
                    step, last = step + 1, more
                a, b = small[start : start + step], large[first:last]
                if len(b):
                    apart = np.zeros((len(a), len(b)), np.int32)
                    for j in range(w):
                        apart += np.bitwise_count(mine[j, start : start + step, None] ^ folded[None, j, first:last])
                    near = apart.astype(np.int64) * (100 + percent) <= (sizes[a][:, None] + sizes[b][None, :]) * (100 - percent)
                    near &= a[:, None] != b[None, :]
                    if two_sided:
                        near &= side[a][:, None] != side[b][None, :]
                    found[a[near.any(axis=1)]] = True
                    found[b[near.any(axis=0)]] = True
                start += step
    return found


def _profile(k: int, percent: int):
    """Batches of (doc_id, text) to sizes, set signatures, prefixes and sketches."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n", pa.int64()),
            ("k1", pa.int64()),
            ("k2", pa.int64()),
            ("prefix", pa.list_(pa.int64())),
            ("sketch", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordCache(word_code)
        for batch in batches:
            ids = batch.column("doc_id")
            for first, texts in text_chunks(batch, "text"):
                sets = ngram_sets(texts, k, cache)
                sizes = np.array([len(s) for s in sets], np.int64)
                signs = signatures(sets)
                lengths = np.where(sizes > 0, np.minimum(sizes, sizes - needed(sizes, percent) + 1 + extra(sizes)), 0)
                ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                prefix = np.concatenate([s[:p] for s, p in zip(sets, lengths)] or [np.empty(0, np.uint64)])
                yield pa.record_batch(
                    [
                        ids.slice(first, len(texts)),
                        pa.array(sizes),
                        pa.array(signs[0]),
                        pa.array(signs[1]),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(prefix.view(np.int64))),
                        pa.array(sketches(sets), pa.binary()),
                    ],
                    schema=schema,
                )

    return run, "doc_id long, n long, k1 long, k2 long, prefix array<long>, sketch binary"


def _full_sets(k: int):
    """Batches of (node, text) to the bytes of the whole set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordCache(word_code)
        for batch in batches:
            for first, texts in text_chunks(batch, "text"):
                sets = ngram_sets(texts, k, cache)
                signs = signatures(sets)
                yield pa.record_batch(
                    [
                        batch.column("node").slice(first, len(texts)),
                        pa.array(signs[0]),
                        pa.array(signs[1]),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    names=["node", "k1", "k2", "grams"],
                )

    return run, "node long, k1 long, k2 long, grams binary"


def forest(nodes: np.ndarray, sets: list[np.ndarray], side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Edges that join rows exactly as their links do. ``side``: 0 and 1 rows are only held against each
    other; with one side only, all against all."""
    two_sided = side.min() != side.max()
    order = np.argsort([len(s) for s in sets], kind="stable")
    sizes = np.array([len(sets[i]) for i in order], np.int64)
    nodes, side = nodes[order], side[order]
    row = np.repeat(np.arange(len(order)), sizes)
    gram = np.concatenate([sets[i] for i in order])
    while True:  # n-grams of one row and rows that can't reach a partner
        _, gram = np.unique(gram, return_inverse=True)
        shared = np.bincount(gram)[gram] > 1
        left = np.bincount(row[shared], minlength=len(sizes))
        keep = shared & (left >= needed(sizes, percent))[row]
        if keep.all():
            break
        row, gram = row[keep], gram[keep]
        if not len(row):
            return []
    by_gram = np.argsort(gram, kind="stable")  # postings, each in order of set size
    post_row = row[by_gram]
    post_end = np.cumsum(np.bincount(gram))
    place = np.empty(len(gram), np.int64)
    place[by_gram] = np.arange(len(gram))
    first = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(sizes)))])
    later = post_end[gram] - place - 1  # partners that come after an entry in its posting
    parent = np.arange(len(sizes))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    edges = []
    work = np.concatenate([[0], np.cumsum(later)])
    start = 0
    while start < len(sizes):
        end = start + 1
        while end < len(sizes) and work[first[end + 1]] - work[first[start]] <= _PRODUCT_CELLS and end - start < 256:
            end += 1
        counts = later[first[start] : first[end]]
        lines = np.repeat(row[first[start] : first[end]] - start, counts)
        steps = np.arange(len(lines)) - np.repeat(np.cumsum(counts) - counts, counts)
        partner = post_row[np.repeat(place[first[start] : first[end]], counts) + 1 + steps]
        cells, overlap = np.unique(lines * len(sizes) + partner, return_counts=True)
        a, b = start + cells // len(sizes), cells % len(sizes)
        linked = 100 * overlap >= percent * (sizes[a] + sizes[b] - overlap)
        if two_sided:
            linked &= side[a] != side[b]
        for x, y in zip(a[linked].tolist(), b[linked].tolist()):
            p, q = root(x), root(y)
            if p != q:
                parent[max(p, q)] = min(p, q)
                edges.append((int(nodes[x]), int(nodes[y])))
        start = end
    return edges


def _likely(percent: int):
    def run(table: pa.Table) -> pa.Table:
        found = np.zeros(len(table), bool)
        if len(table) > 1:
            found = likely(table.column("n").to_numpy(), table.column("sketch").to_pylist(), table.column("side").to_numpy(), percent)
        return table.select([*_SET, "node", "n", "block"]).filter(pa.array(found))

    return run, "k1 long, k2 long, node long, n long, block long"


def _block(percent: int):
    def run(table: pa.Table) -> pa.Table:
        sets = [np.frombuffer(g, np.uint64) for g in table.column("grams").to_pylist()]
        nodes = table.column("node").to_numpy()
        edges = forest(nodes, sets, table.column("side").to_numpy(), percent) if len(sets) > 1 else []
        return pa.table({"a": pa.array([e[0] for e in edges], pa.int64()), "b": pa.array([e[1] for e in edges], pa.int64())})

    return run, "a long, b long"


def _placed(members: DataFrame, most_rows: int, most_grams: int) -> DataFrame:
    """Rows of each block in its groups, which are the pairs of its parts; blocks of one row are left out."""
    blocks = members.groupBy("block").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("grams"))
    parts = F.greatest(F.ceil(F.col("rows") / most_rows), F.ceil(F.col("grams") / most_grams)).cast("int")
    blocks = blocks.filter("rows > 1").select("block", parts.alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    placed = members.join(blocks, "block").select(*_SET, "node", "n", "block", part.alias("own"), other.alias("other"))
    return placed.select(
        *_SET,
        "node",
        "n",
        "block",
        F.least("own", "other").alias("p"),
        F.greatest("own", "other").alias("q"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
    )


def jaccard_components(documents: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for each row of ``documents`` (``doc_id``, ``text``).

    Two rows link when ``100 * intersection >= percent * union`` of their sets of distinct ``k``-word
    n-grams, with A-Z in lower case. A text of fewer than ``k`` words is one n-gram; one without words, and
    a null text, has none and links with nothing. ``component_id`` is the smallest ``doc_id`` reachable. Rows
    with equal text link like any others, also when they repeat a ``doc_id``. A row without ``doc_id``
    keeps a null component and links with nothing. An empty table gives an empty result.
    """
    with scratch(documents.sparkSession):
        return materialize(_components(documents, k, percent), "ngram-components", keep=True)


def _components(documents: DataFrame, k: int, percent: int) -> DataFrame:
    run, schema = _profile(k, percent)
    slim = documents.select("doc_id", "text")
    rows = materialize(slim.mapInArrow(run, schema), "ngram-rows")
    usable = rows.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    classes = materialize(
        usable.groupBy(*_SET).agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("sketch").alias("sketch")),
        "ngram-classes",
    )
    known = classes.select(*_SET, "node", "n")

    # both sides of these joins grow with the input: merge joins at every size, split by adaptive execution where skewed
    # hardly a hash comes twice in one task, so they are shuffled once, as they are, for both the aggregation and the join with it.
    # the filter, which the joins imply, makes both read the same exchange
    entries = usable.select(*_SET, F.explode("prefix").alias("gram"))
    entries = entries.filter("k1 is not null and k2 is not null and gram is not null").repartition("gram")
    ends = [f(k).alias(f"{name}_{k}") for k in _SET for name, f in (("least", F.min), ("most", F.max))]
    shared = entries.groupBy("gram").agg(*ends, F.count(F.lit(1)).alias("times"))
    shared = shared.filter("least_k1 <> most_k1 or least_k2 <> most_k2").select("gram", F.col("least_k1").alias("block"), "times")
    touched = entries.join(shared.hint("merge"), "gram").select(*_SET, "gram", "block", "times").distinct()
    # a partner has at least needed(n) n-grams, and the pair shares more prefix hashes than its smaller extra()
    more = F.expr(f"((n * {percent} + 99) div 100) * {EXTRA_PERCENT} div 100")
    most_frequent_first = Window.partitionBy(*_SET).orderBy(F.desc("times"), "gram")
    members = materialize(
        touched.join(known.hint("merge"), _SET)
        .withColumn("place", F.row_number().over(most_frequent_first))
        .filter(F.col("place") > more)
        .select(*_SET, "node", "n", "block")
        .distinct(),
        "ngram-members",
    )
    run, schema = _likely(percent)
    sketched = _placed(members, SKETCH_ROWS, SKETCH_NGRAMS).join(classes.select(*_SET, "sketch").hint("merge"), _SET)
    members = materialize(sketched.groupBy("block", "p", "q").applyInArrow(run, schema).distinct(), "ngram-likely")
    placed = _placed(members, BLOCK_ROWS, BLOCK_NGRAMS)

    run, schema = _full_sets(k)
    wanted = placed.select("node").distinct()
    texts = slim.withColumnRenamed("doc_id", "node").join(wanted.hint("merge"), "node")
    sets = materialize(texts.mapInArrow(run, schema).dropDuplicates(["node", *_SET]), "ngram-sets")
    run, schema = _block(percent)
    edges = placed.join(sets.hint("merge"), ["node", *_SET]).groupBy("block", "p", "q").applyInArrow(run, schema)
    linked = components(edges)
    ends = classes.join(linked, "node", "left").select(
        "k1", "k2", F.coalesce("component", "node").alias("_component"), F.lit(True).alias("_class")
    )
    found = rows.select("doc_id", "n", "k1", "k2").join(ends, _SET, "left")
    known = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(known, F.col("_component")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def keep_one_per_component(documents: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents that are the smallest id of their component, all columns; rows without id stay.

    Of rows that repeat a document id all stay or all go: they are one document.
    """
    found = jaccard_components(documents, k, percent).filter(F.col("doc_id") != F.col("component_id"))
    gone = found.select(F.col("doc_id").alias("_gone")).distinct()
    # a merge join at every size, as above: the list grows with the input
    return documents.join(gone.hint("merge"), F.col("doc_id") == F.col("_gone"), "left_anti")
