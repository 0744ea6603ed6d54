import numpy as np
import pytest

from docweave.llm import mixing as M
from llm.conftest import EDGE_TEXTS


def water_fill(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        level = left / sum(w[s] for s in open_)
        over = [s for s in open_ if level * w[s] > most * sizes[s]]
        if not over:
            return target | {s: level * w[s] for s in open_}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


def corpus(noise):
    rows, rng = [], np.random.default_rng(3)
    for i in range(400):
        source = ["a", "b", "c", "Z", "é", None, "hot", "hot", "hot"][i % 9]
        rows.append((i, " ".join(noise(int(rng.integers(0, 400)), i)), source))
    return rows


def test_targets_and_takes(docs, noise):
    rows = corpus(noise)
    got = M.mix_sources(docs(rows)).collect()
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    expected = water_fill(sizes)
    assert {r["doc_id"]: r["size"] for r in got} == {i: len(t.split()) for i, t, _ in rows}
    taken = {}
    for r in got:
        assert r["target"] == pytest.approx(expected[r["source"]])
        assert r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for source, target in expected.items():
        assert abs(taken[source] - target) <= 1.5 * M.BLOCK_WORDS


def test_reruns_agree_and_other_partitioning_too(docs, noise):
    rows = corpus(noise)[:100]
    once = sorted(tuple(r) for r in M.mix_sources(docs(rows)).drop("source").collect())
    again = sorted(tuple(r) for r in M.mix_sources(docs(rows[::-1]).repartition(7)).drop("source").collect())
    assert once == again


def test_blocks_hold_the_words_taken(docs, noise):
    rows = corpus(noise)[:60]
    words = {i: t.split() for i, t, _ in rows}
    taken = {r["doc_id"]: r["taken"] for r in M.mix_sources(docs(rows)).collect()}
    seen = dict.fromkeys(taken, 0)
    for r in M.mixed_blocks(docs(rows)).collect():
        assert len(r["text"].split()) <= M.BLOCK_WORDS
        for doc in r["doc_ids"]:
            seen[doc] += len(set(r["text"].split()) & set(words[doc])) > 0
        assert all(any(w in words[d] for d in r["doc_ids"]) for w in r["text"].split())
    assert all((seen[d] > 0) == (taken[d] > 0) for d in taken)


def test_permutation_is_a_permutation():
    for n in (1, 2, 3, 7, 64, 1000):
        j = np.arange(n)
        out = M.permute(j, np.full(n, n), np.full(n, 12345))
        assert sorted(out.tolist()) == list(range(n))
    assert (M.permute(np.arange(1000), np.full(1000, 1000), np.full(1000, 1)) != np.arange(1000)).mean() > 0.9


def test_small_shards_keep_totals(docs, noise):
    rows = corpus(noise)[:120]
    one = M.mix_sources(docs(rows), shard_slots=10**6).groupBy("source").sum("taken").collect()
    many = M.mix_sources(docs(rows), shard_slots=5).groupBy("source").sum("taken").collect()
    assert sorted(map(tuple, one), key=str) == sorted(map(tuple, many), key=str)


def test_edge_rows_empty_table_and_clashing_names(docs):
    rows = [(i, t, None) for i, t in enumerate(EDGE_TEXTS)] + [(None, "a b", "s"), (1, "a b", "s"), (1, "a b", "s")]
    df = docs(rows).withColumnRenamed("lang", "size").withColumnRenamed("n_chars", "uid")
    got = M.mix_sources(df).collect()
    assert len(got) == len(rows)
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    assert M.mix_sources(docs([])).count() == 0
    assert M.mix_sources(docs([(1, None, "a"), (2, "", "b")])).groupBy().sum("taken").first()[0] == 0


def test_offsets_over_bundles_and_many_tasks(spark, docs, noise, monkeypatch):
    """Small bundles, shards and tasks change where slots are made, not which."""
    rows = [(i, " ".join(noise(40 + i % 7, i)), "hot" if i % 3 else f"s{i % 4}") for i in range(90)]
    whole = sorted(tuple(r) for r in M.mix_sources(docs(rows), block_words=4, shard_slots=16).collect())
    shards = sorted(tuple(r) for r in M.mixed_blocks(docs(rows), block_words=4, shard_slots=16).collect())
    for name, value in (("BUNDLE_SHARDS", 3), ("SLOTS_A_TASK", 50), ("SHARD_SLOTS", 5)):
        monkeypatch.setattr(M, name, value)
    assert sorted(tuple(r) for r in M.mix_sources(docs(rows), block_words=4, shard_slots=16).collect()) == whole
    again = M.mixed_blocks(docs(rows), block_words=4, shard_slots=16)
    assert sorted(tuple(r) for r in again.collect()) == shards
    slots = [(r["number"], r["slot"]) for r in again.select("number", "slot").collect()]
    assert len(set(slots)) == len(slots)
    sources = M.quotas(M.targets(M.positioned(docs(rows))), 4)
    ranges = M.draw_shards(sources, 16, 1)
    assert M.slots_of(ranges, sum(r["slots"] for r in sources.collect()), 1).rdd.getNumPartitions() > 8
