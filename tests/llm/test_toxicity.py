import zlib

import numpy as np

from docweave.llm import toxicity as T
from llm.conftest import EDGE_TEXTS

LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark, sf):
    folder = sf.replace("0.001", "0.1")
    documents, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = T.score_toxicity(documents, labels).join(labels, "doc_id").collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    unseen = [r for r in rows if r["held_out"]]
    toxic = [r["predicted"] for r in unseen if r["toxic"] == 1]
    clean = [r["predicted"] for r in unseen if r["toxic"] == 0]
    assert len(toxic) > 100 and np.mean(toxic) > 0.7
    assert np.mean(clean) < 0.02


def planted(noise):
    rows, labels = [], []
    for i in range(600):
        words = [noise(9, 1000 * i + s) for s in range(6)]
        bad = i % 5 == 0
        if bad:
            words[i % 6][4] = "vilest"
        rows.append((i, "\n".join(" ".join(w) + "." for w in words)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_locates_the_offending_sentence(spark, docs, noise):
    rows, labels = planted(noise)
    got = T.score_toxicity(docs(rows), spark.createDataFrame(labels, LABELS)).collect()
    unseen = [r for r in got if r["held_out"]]
    assert len(unseen) > 100
    for r in unseen:
        bad = r["doc_id"] % 5 == 0
        assert r["predicted"] == bad
        # a line is one sentence: its full stop; the end of the line adds an empty one
        assert r["offending"] == ([2 * (r["doc_id"] % 6)] if bad else [])


def test_held_out_labels_are_not_learnt(spark, docs, noise):
    rows, labels = planted(noise)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    a, b = (
        {r["doc_id"]: r["score"] for r in T.score_toxicity(docs(rows), spark.createDataFrame(x, LABELS)).collect()}
        for x in (labels, turned)
    )
    assert a == b


def test_edge_rows_and_labels(spark, docs):
    df = docs([*enumerate(EDGE_TEXTS), (None, "a"), (3, "a")]).withColumnRenamed("n_chars", "score")
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (None, 1, 1), (2, None, None), (3, 0, 0), (99, 0, 0)], LABELS)
    for given in (labels, labels.limit(0)):
        got = T.score_toxicity(df, given).collect()
        assert len(got) == len(EDGE_TEXTS) + 2
        assert all(0 <= r["score"] <= 1 for r in got)
    assert T.score_toxicity(docs([]), labels).count() == 0
