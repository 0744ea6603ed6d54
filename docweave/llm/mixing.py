"""Mix sources to target weights, in blocks of a fixed number of words.

The documents of a source, in id order, form one stream of words; every ``block_words`` of it are a block. A
source takes part with a number of *slots*, one for each block of the mix. Output shards of
``shard_slots`` slots draw their source counts from a multinomial; what a shard draws beyond the quota of a source is cut and a
last shard gets what is missing, so the totals are exact. Slot j of a source takes block
``p(j mod blocks)`` where p is a pseudorandom permutation of its own for every pass over the source (a
keyed Feistel network walked until it falls inside). So no block is taken twice before all are taken once.

A source's words miss its target by half a block, and by the short last block of its stream, at most.
The driver sees one row for each source and, for the offsets, joins one row for each partition and source: sources are meant to be named
collections, up to some ten thousand of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from docweave.llm.words import mix, text_chunks
from docweave.session import materialize

BLOCK_WORDS = 32
SHARD_SLOTS = 8192
BUNDLE_SHARDS = 1024
SLOTS_A_TASK = 1 << 18
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = 20_240_601
_PART_BITS = 33


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of every text; the text itself goes on where it is asked for."""
    for batch in batches:
        rest = [n for n in batch.schema.names if n != "_words"]
        for first, texts in text_chunks(batch, "_words"):
            sizes = pa.array([len(t.split()) if t else 0 for t in texts], pa.int64())
            part = batch.slice(first, len(texts))
            yield pa.record_batch([*[part.column(n) for n in rest], sizes], names=[*rest, "size"])


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words before each row among the rows of its source in this sorted partition."""
    source, total, started = None, 0, False
    for batch in batches:
        sources, sizes = batch.column("source").to_pylist(), batch.column("size").to_pylist()
        before = []
        for s, n in zip(sources, sizes):
            if not started or s != source:
                source, total, started = s, 0, True
            before.append(total)
            total += n
        yield batch.append_column("before", pa.array(before, pa.int64()))


def positioned(documents: DataFrame, with_text: bool = False) -> DataFrame:
    """(uid, doc_id, source, size, start[, text]): where each row lies in the stream of its source."""
    extra = [F.col("text")] if with_text else []
    slim = documents.select("doc_id", "source", F.col("text").alias("_words"), *extra)
    text = ", text string" if with_text else ""
    sized = slim.mapInArrow(_sizes, f"doc_id long, source string{text}, size long")
    ranged = sized.repartitionByRange("source", "doc_id", "size").sortWithinPartitions("source", "doc_id", "size")
    ranged = ranged.withColumn("uid", F.monotonically_increasing_id())
    rows = ranged.mapInArrow(_running, f"doc_id long, source string{text}, size long, uid long, before long")
    rows = materialize(rows, "mix-rows").withColumn("part", F.shiftright("uid", _PART_BITS))
    runs = rows.groupBy("part", "source").agg(F.sum("size").alias("n"))  # one row for each partition and source
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col("part").alias("_part"), F.col("source").alias("_source"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_base")
    )
    same = (F.col("part") == F.col("_part")) & F.col("source").eqNullSafe(F.col("_source"))
    placed = rows.join(F.broadcast(runs), same).withColumn("start", F.col("before") + F.col("_base"))
    return placed.select("uid", "doc_id", "source", "size", "start", *(["text"] if with_text else []))


def targets(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, number, source_size, target): weights by code point order of the sources, null last.

    Together ``share`` times all words; a target stops at ``most`` times its source, the excess goes to
    the others by weight. In order of size to weight the stopped sources come first, so one pass over
    the source rows finds the level of the rest.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    given = F.array(*[F.lit(float(w)) for w in weights])
    sizes = sizes.withColumn("number", F.row_number().over(order) - 1)
    sizes = sizes.withColumn("w", F.element_at(given, (F.pmod("number", F.lit(len(weights))) + 1).cast("int")))
    sizes = sizes.withColumn("cap", F.col("source_size") * float(most)).withColumn("ratio", F.col("cap") / F.col("w"))
    everything = Window.partitionBy(F.lit(0))
    filled = everything.orderBy("ratio", "number").rowsBetween(Window.unboundedPreceding, -1)
    rest = everything.orderBy("ratio", "number").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything) * share
    sizes = sizes.withColumn("level", (total - F.coalesce(F.sum("cap").over(filled), F.lit(0.0))) / F.sum("w").over(rest))
    stopped = F.col("ratio") < F.col("level")
    sizes = sizes.withColumn("stopped", stopped)
    level = F.max(F.when(~F.col("stopped"), F.col("level"))).over(everything)
    return sizes.select(
        "source",
        "number",
        "source_size",
        F.when(F.col("stopped"), F.col("cap")).otherwise(F.least(level * F.col("w"), F.col("cap"))).alias("target"),
    )


def quotas(sources: DataFrame, block_words: int) -> DataFrame:
    """Adds ``blocks`` and the number of ``slots`` whose words come nearest to the target."""
    blocks = F.ceil(F.col("source_size") / block_words)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.round((F.col("target") - passes * F.col("source_size")) / block_words)
    return sources.withColumn("blocks", blocks).withColumn(
        "slots", F.least(passes * blocks + F.least(rest, blocks), F.lit(MOST) * blocks).cast("long")
    )


def draw_shards(sources: DataFrame, shard_slots: int, seed: int) -> DataFrame:
    """(number, blocks, shard, lo, hi): the slots lo..hi-1 of a source that an output shard takes.

    A shard's first slot of a source is the running sum of the draws before it, made from bundles of shards: a bundle's sum of all
    earlier bundles, and the shards before it in its bundle. So no task sees all shards of a source.
    """
    spark = sources.sparkSession
    rows = sorted((r["number"], r["slots"]) for r in sources.select("number", "slots").collect())  # one row a source
    total = sum(n for _, n in rows)
    shards = -(-total // shard_slots)
    share = np.array([n for _, n in rows], float) / max(total, 1)
    share = share / share.sum() if total else share
    numbers = np.array([n for n, _ in rows], np.int64)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column("id").to_pylist():
                size = min(shard_slots, total - shard * shard_slots)
                counts = np.random.default_rng([seed, shard]).multinomial(size, share)
                some = counts > 0
                yield pa.record_batch(
                    [pa.array(np.full(some.sum(), shard)), pa.array(numbers[some]), pa.array(counts[some])],
                    names=["shard", "number", "n"],
                )

    drawn = spark.range(shards).mapInArrow(draw, "shard long, number long, n long")
    drawn = drawn.withColumn("bundle", F.floor(F.col("shard") / BUNDLE_SHARDS))
    earlier = Window.partitionBy("number").orderBy("bundle").rowsBetween(Window.unboundedPreceding, -1)
    bundles = drawn.groupBy("number", "bundle").agg(F.sum("n").alias("_n"))
    bundles = bundles.select("number", "bundle", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("base"))
    upto = Window.partitionBy("number", "bundle").orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    drawn = drawn.join(bundles, ["number", "bundle"]).withColumn("end", F.col("base") + F.sum("n").over(upto))
    small = F.broadcast(sources.select("number", "blocks", "slots"))  # one row for each source
    taken = drawn.join(small, "number").select(
        "number", "blocks", "shard", F.least(F.col("end") - F.col("n"), "slots").alias("lo"), F.least("end", "slots").alias("hi")
    )
    sums = drawn.groupBy("number").agg(F.sum("n").alias("n"))
    short = sources.select("number", "blocks", "slots").join(F.broadcast(sums), "number", "left")
    short = short.select(
        "number", "blocks", F.lit(shards).cast("long").alias("shard"), F.coalesce("n", F.lit(0)).alias("lo"), F.col("slots").alias("hi")
    )
    return taken.unionByName(short).filter("hi > lo")


def permute(j: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Place of index ``j`` under the permutation of 0..n-1 that ``key`` names (arrays of one length)."""
    bits = np.maximum(np.ceil(np.log2(np.maximum(n, 2))), 2).astype(np.uint64)
    half = (bits + np.uint64(1)) // np.uint64(2)
    mask = (np.uint64(1) << half) - np.uint64(1)
    x, n, key = j.astype(np.uint64), n.astype(np.uint64), key.astype(np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        m, h, k = mask[todo], half[todo], key[todo]
        left, right = x[todo] >> h, x[todo] & m
        for step in range(4):
            left, right = right, left ^ (mix(right + mix(k + np.uint64(step))) & m)
        x[todo] = (left << h) | right
        todo = todo[x[todo] >= n[todo]]
    return x.astype(np.int64)


def _blocks_of(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            j, n = batch.column("slot").to_numpy(), batch.column("blocks").to_numpy()
            number = batch.column("number").to_numpy()
            passes = (j // n).astype(np.uint64)
            key = mix(mix(number.astype(np.uint64) + np.uint64(seed)) + passes)
            block = permute(j % n, n, key) if len(j) else j
            yield pa.record_batch(
                [batch.column("number"), batch.column("shard"), batch.column("slot"), pa.array(block)],
                names=["number", "shard", "slot", "block"],
            )

    return run, "number long, shard long, slot long, block long"


def slots_of(ranges: DataFrame, total: int, seed: int) -> DataFrame:
    """(number, shard, slot, block) for every slot of the mix, ``total`` in all.

    Ranges are cut to pieces of a shard's size and dealt to tasks by (source, place) before they become slots: a source with a
    third of all words takes part in all tasks.
    """
    run, schema = _blocks_of(seed)
    first = F.explode(F.sequence(F.col("lo"), F.col("hi") - 1, F.lit(SHARD_SLOTS).cast("long"))).alias("at")
    pieces = ranges.select(F.col("number").cast("long").alias("number"), F.col("blocks").cast("long").alias("blocks"), "shard", "hi", first)
    dealt = pieces.repartition(max(1, -(-total // SLOTS_A_TASK)), "number", "at")
    upto = F.least(F.col("at") + SHARD_SLOTS, "hi") - 1
    slots = dealt.select("number", "blocks", "shard", F.explode(F.sequence(F.col("at"), upto)).alias("slot"))
    return slots.mapInArrow(run, schema)


def _plan(documents, weights, share, block_words, shard_slots, seed, with_text=False):
    rows = positioned(documents, with_text)
    sources = materialize(quotas(targets(rows, weights, share), block_words), "mix-sources")
    total = sources.agg(F.sum("slots")).first()[0] or 0
    slots = slots_of(draw_shards(sources, shard_slots, seed), total, seed)
    same = F.col("source").eqNullSafe(F.col("_source"))
    numbers = sources.withColumnRenamed("source", "_source").select("_source", "number", "source_size", "target")
    rows = rows.join(F.broadcast(numbers), same).drop("_source")  # one row for each source
    first, last = F.col("start"), F.col("start") + F.col("size")
    blocks = F.sequence(F.floor(first / block_words), F.floor((last - 1) / block_words))
    pieces = rows.filter("size > 0").withColumn("block", F.explode(blocks))
    lo = F.greatest(first, F.col("block") * block_words)
    pieces = pieces.withColumn("lo", lo - first).withColumn("hi", F.least(last, (F.col("block") + 1) * block_words) - first)
    return rows, pieces, slots


def mix_sources(
    documents: DataFrame,
    weights=WEIGHTS,
    share: float = SHARE,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    seed: int = SEED,
) -> DataFrame:
    """Per row of ``documents``: doc_id, source, size, source_size, target and ``taken`` words.

    A null text has no words; null is a source of its own, the last in order. Rows that repeat are separate
    documents. A source without words gets a target of 0. Runs with equal rows and seed agree. An empty
    table gives an empty result.
    """
    rows, pieces, slots = _plan(documents, weights, share, block_words, shard_slots, seed)
    times = slots.groupBy("number", "block").agg(F.count(F.lit(1)).alias("times"))
    took = pieces.select("uid", "number", "block", (F.col("hi") - F.col("lo")).alias("n")).join(times, ["number", "block"])
    took = took.groupBy("uid").agg(F.sum(F.col("n") * F.col("times")).alias("taken"))
    return rows.join(took, "uid", "left").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary()).to_pylist()
        spans = batch.column("spans").to_pylist()
        out = {c: [] for c in ("number", "block", "lo", "doc_id", "words")}
        for i, (text, number, doc) in enumerate(zip(texts, batch.column("number").to_pylist(), batch.column("doc_id").to_pylist())):
            words = text.split()
            for s in spans[i]:
                for c, v in zip(out, (number, s["block"], s["at"], doc, b" ".join(words[s["lo"] : s["hi"]]).decode())):
                    out[c].append(v)
        yield pa.record_batch(
            [pa.array(out[c], pa.string() if c == "words" else pa.int64()) for c in out], names=list(out)
        )


def mixed_blocks(documents: DataFrame, weights=WEIGHTS, share=SHARE, block_words=BLOCK_WORDS, shard_slots=SHARD_SLOTS, seed=SEED):
    """The mix itself: (shard, slot, source number, block, doc_ids, text), a row for every slot."""
    _, pieces, slots = _plan(documents, weights, share, block_words, shard_slots, seed, with_text=True)
    span = F.struct("block", "lo", "hi", (F.col("start") + F.col("lo")).alias("at"))
    cut = pieces.groupBy("uid", "number", "doc_id", "text").agg(F.collect_list(span).alias("spans"))
    cut = cut.select("number", "doc_id", "text", "spans").mapInArrow(
        _cut, "number long, block long, lo long, doc_id long, words string"
    )
    parts = F.sort_array(F.collect_list(F.struct("lo", "doc_id", "words")))  # a block has at most block_words pieces
    blocks = cut.groupBy("number", "block").agg(parts.alias("parts"))
    return slots.join(blocks, ["number", "block"]).select(
        "shard", "slot", "number", "block", F.col("parts.doc_id").alias("doc_ids"), F.array_join("parts.words", " ").alias("text")
    )
