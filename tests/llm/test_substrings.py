import hashlib
import random

import numpy as np

from docweave.llm import substrings as S
from docweave.llm.fm_index import BitVector, FMIndex, WaveletMatrix
from llm.conftest import EDGE_TEXTS


def brute(rows):
    words = [(d, (t or "").encode().split()) for d, t in rows]
    least = {}
    for doc, w in words:
        if doc is not None:
            for i in range(len(w) - 12):
                k = tuple(w[i : i + 13])
                least[k] = min(doc, least.get(k, doc))
    out = []
    for doc, w in words:
        gone = set()
        if doc is not None:
            for i in range(len(w) - 12):
                if least[tuple(w[i : i + 13])] < doc:
                    gone |= set(range(i, i + 13))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


def corpus(noise):
    rng, rows = random.Random(2), []
    passages = [noise(rng.randrange(10, 90), 50 + i) for i in range(12)]
    common = noise(20, 49)
    for i in range(150):
        words = noise(rng.randrange(0, 60), 1000 + i)
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            words += p[a : a + rng.randrange(5, 60)]
        words += common if i % 3 == 0 else []
        rows.append((500 - i if i % 2 else i, " ".join(words + noise(rng.randrange(0, 30), 5000 + i))))
    rows += [(700 + i, rows[0][1]) for i in range(5)] + [(900, "aa " * 60), (901, "aa " * 30)]
    return rows


def test_agrees_with_brute_force(docs, noise):
    rows = corpus(noise)
    assert found(S.remove_repeats(docs(rows))) == brute(rows)


def test_hot_leaders_and_many_shards(docs, noise, monkeypatch):
    monkeypatch.setattr(S, "SHARD_WORDS", 200)
    monkeypatch.setattr(S, "UNIT_WINDOWS", 7)
    rows = corpus(noise)
    expected = brute(rows)
    for most in (10**9, 600, 0):  # by minimizer, some by window, all by window
        monkeypatch.setattr(S, "MOST_WORDS", most)
        assert found(S.remove_repeats(docs(rows))) == expected


def test_edge_texts_null_ids_and_empty_table(docs, noise):
    text = " ".join(noise(40))
    rows = [*enumerate(EDGE_TEXTS), (None, text), (60, text), (61, text), (61, text), (62, text.upper())]
    df = docs(rows).withColumnRenamed("n_chars", "kept").withColumnRenamed("lang", "marks")
    assert found(S.remove_repeats(df)) == brute(rows)
    assert S.remove_repeats(docs([])).count() == 0


def test_ranks_of_bits_and_symbols():
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2, 1000).astype(np.uint8)
    at = np.arange(1001)
    assert (BitVector(bits).rank(at) == np.concatenate([[0], np.cumsum(bits)])).all()
    symbols = rng.integers(0, 37, 500)
    wavelet = WaveletMatrix(symbols, 37)
    for s in range(37):
        assert (wavelet.rank(np.full(501, s), np.arange(501)) == np.concatenate([[0], np.cumsum(symbols == s)])).all()


def test_index_groups_equal_windows():
    rng = np.random.default_rng(2)
    for depth in (2, 3, 5, 13):
        sequences = [rng.integers(0, 3, n).astype(np.uint64) for n in (40, 12, 1, 30, 13)]
        index = FMIndex(sequences, depth)
        seen = {}
        for s, groups in zip(sequences, index.groups_of_windows()):
            assert len(groups) == max(0, len(s) - depth + 1)
            for i, g in enumerate(groups.tolist()):
                assert seen.setdefault(tuple(s[i : i + depth].tolist()), g) == g
        assert len(set(seen.values())) == len(seen)
