import random

import numpy as np

from docweave.llm import ngram_join
from docweave.llm.graph import components
from llm.conftest import EDGE_TEXTS


def brute(rows, k, percent):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        if len(words) >= k:
            sets.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)})
        else:
            sets.append({tuple(words)} if words else set())
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            inter = len(a & sets[j])
            if inter and 100 * inter >= percent * (len(a) + len(sets[j]) - inter):
                label[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted((rows[i][0], len(sets[i]), least[root(i)]) for i in range(len(rows)))


def found(df):
    return sorted(tuple(r) for r in df.collect())


def near_copies(noise, n_groups=6, copies=30, seed=1):
    rng, rows = random.Random(seed), []
    shared = noise(15, 99)
    for g in range(n_groups):
        base = noise(rng.randrange(20, 200), 100 + g)
        for c in range(copies):
            words = list(base)
            for _ in range(rng.randrange(0, 6)):
                words[rng.randrange(len(words))] = f"edit{rng.randrange(1000)}"
            rows.append((1000 - len(rows), " ".join(words)))
    rows += [(2000 + i, " ".join(noise(40, 500 + i) + shared)) for i in range(30)]
    return rows


def test_agrees_with_brute_force(docs, noise, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 8)  # blocks of several parts
    monkeypatch.setattr(ngram_join, "_PRODUCT_CELLS", 300)
    rows = near_copies(noise)
    assert found(ngram_join.jaccard_components(docs(rows))) == brute(rows, 4, 85)
    assert found(ngram_join.jaccard_components(docs(rows), 5, 80)) == brute(rows, 5, 80)


def test_forest_of_random_sets():
    rng = np.random.default_rng(0)
    for trial in range(30):
        sets = [np.unique(rng.integers(0, 30, rng.integers(1, 25)).astype(np.uint64)) for _ in range(25)]
        edges = ngram_join.forest(np.arange(25), sets, np.zeros(25, int), 70)
        links = {
            (i, j)
            for i in range(25)
            for j in range(i)
            if 100 * len(np.intersect1d(sets[i], sets[j])) >= 70 * len(np.union1d(sets[i], sets[j]))
        }
        assert {tuple(sorted(e, reverse=True)) for e in edges} <= links

        def label(pairs):
            out = list(range(25))
            for _ in range(25):
                for a, b in pairs:
                    out[a] = out[b] = min(out[a], out[b])
            return out

        assert label(edges) == label(links)


def test_sketches_miss_no_pair_and_tell_others_apart(monkeypatch):
    monkeypatch.setattr(ngram_join, "_SKETCH_CELLS", 50)
    rng = np.random.default_rng(1)
    base = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (1, 5, 40, 64, 70, 128, 130, 700)]
    sets = list(base)
    for s in base[2:]:  # of each size, and of sketches of other widths
        for change in (0.03, 0.08, 0.12):
            kept = s[rng.random(len(s)) >= change]
            sets.append(np.unique(np.concatenate([kept, rng.integers(0, 1 << 63, int(len(s) * change)).astype(np.uint64)])))
    strangers = [np.unique(rng.integers(0, 1 << 63, 300 + i).astype(np.uint64)) for i in range(20)]
    sets += strangers
    sizes = np.array([len(s) for s in sets])
    for percent in (60, 85):
        for side in (np.zeros(len(sets), int), np.arange(len(sets)) % 2):
            got = ngram_join.likely(sizes, ngram_join.sketches(sets), side, percent)
            for i, a in enumerate(sets):
                partners = [
                    j
                    for j, b in enumerate(sets)
                    if i != j
                    and (side[i] != side[j] or not side.any())
                    and 100 * len(np.intersect1d(a, b)) >= percent * len(np.union1d(a, b))
                ]
                assert got[i] or not partners
            assert not got[-len(strangers) :].any()


def test_whole_sets_are_sent_for_likely_pairs_only(docs, noise, monkeypatch):
    nodes = {}

    def seen(df, purpose, plain=ngram_join.materialize, **options):
        table = plain(df, purpose, **options)
        nodes[purpose] = {r["node"] for r in table.collect()} if "node" in table.columns else None
        return table

    monkeypatch.setattr(ngram_join, "materialize", seen)
    common = noise(30, 99)
    rows = [(i, " ".join(noise(60 + i % 7, 100 + i) + common)) for i in range(60)]
    pair = noise(80, 1)
    rows += [(1000, " ".join(pair + common)), (1001, " ".join([*pair[:-1], "other", *common]))]
    assert found(ngram_join.jaccard_components(docs(rows))) == brute(rows, 4, 85)
    assert len(nodes["ngram-members"]) > 2
    assert nodes["ngram-sets"] == {1000, 1001}


def test_a_pair_that_shares_the_most_frequent_hashes_is_found(docs, noise):
    common = noise(60, 99)
    rows = [(i, " ".join(common[: 20 + i % 40] + noise(30, 100 + i))) for i in range(50)]
    rows += [(100 + i, " ".join([*common[:i], f"edit{i}", *common[i + 1 :], "tail"])) for i in range(0, 60, 7)]
    assert found(ngram_join.jaccard_components(docs(rows))) == brute(rows, 4, 85)


def test_edge_texts_ties_and_repeated_rows(docs, noise):
    rows = [(i, t) for i, t in enumerate(EDGE_TEXTS)]
    rows += [(50, "Same Words HERE now"), (51, "same words here NOW"), (51, "same words here NOW"), (52, "a b"), (53, "A  B")]
    assert found(ngram_join.jaccard_components(docs(rows))) == brute(rows, 4, 85)


def test_null_id_and_empty_table(docs):
    got = [tuple(r) for r in ngram_join.jaccard_components(docs([(None, "a b c d e"), (1, "a b c d e")])).collect()]
    assert sorted(got, key=str) == [(1, 2, 1), (None, 2, None)]
    assert ngram_join.jaccard_components(docs([])).count() == 0


def test_keeps_one_and_all_columns(docs, noise):
    words = noise(60)
    rows = [(3, " ".join(words)), (4, " ".join(words[:-1])), (5, " ".join(noise(60, 7))), (None, "x")]
    df = docs(rows).withColumnRenamed("n_chars", "node")
    kept = ngram_join.keep_one_per_component(df)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {3, 5, None}


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(50)}
