"""The pipeline against its stages by brute force, and what it does to planted documents."""

import os

import numpy as np
import pytest

import corpus_pipeline
from docweave.llm import decontaminate, perplexity
from docweave.session import shared_root
from llm.conftest import SCHEMA
from llm.test_mixing import water_fill
from llm.test_ngram_join import brute as components_by_brute_force


def drop_lines(rows):
    def key(line):
        stripped = line.strip(" \t\n\x0b\f\r")
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in stripped)

    holders = {}
    for doc, text in rows:
        for line in text.split("\n"):
            if len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(doc)
    gone = {k: max(d) for k, d in holders.items() if len(d) >= 3}
    return [(doc, "\n".join(x for x in t.split("\n") if gone.get(key(x), doc) == doc)) for doc, t in rows]


def leaks(text, items):
    cache = decontaminate.WordCache(decontaminate.normal_word)
    words = decontaminate.item_words([text.encode()], cache)[0]
    for item in items:
        known = decontaminate.item_words([item.encode()], cache)[0]
        if len(known) and len(words):  # short items allow no edit: word for word
            if len(np.intersect1d(known, words)) * 2 >= len(set(known.tolist())) and (
                decontaminate.best_passage(known, words)[0] <= decontaminate.allowed(len(known))
            ):
                return True
    return False


def by_brute_force(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    verdict = {r["doc_id"] for r in perplexity.quality_rules(documents).filter("kept").collect()}
    source = {r["doc_id"]: r["source"] for r in documents.collect()}
    rows = sorted((r["doc_id"], r["text"]) for r in documents.collect() if r["doc_id"] in verdict)
    rows = drop_lines(rows)
    group = {doc: least for doc, _, least in components_by_brute_force(rows, 5, 80)}
    rows = [(doc, text) for doc, text in rows if group[doc] == doc]
    items = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = [(doc, text) for doc, text in rows if not leaks(text, items)]
    return {doc: (source[doc], len(text.encode().split())) for doc, text in rows}


@pytest.fixture(scope="module")
def result(spark):
    return corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()


def test_documents_sizes_and_targets(spark, sf, result):
    expected = by_brute_force(spark, sf)
    assert {r["doc_id"]: (r["source"], r["size"]) for r in result} == expected
    sizes = {}
    for source, n in expected.values():
        sizes[source] = sizes.get(source, 0) + n
    target = water_fill(sizes)
    taken = {}
    for r in result:
        assert r["target"] == pytest.approx(target[r["source"]]) and 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert all(abs(taken[s] - target[s]) <= 48 for s in target)


def test_stages_keep_the_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumnRenamed("n_chars", "kept").limit(60)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns


def test_planted_documents(spark, sf, noise):
    clean = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").filter("lang = 'en'").limit(80).collect()]
    item = spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").first()["text"]
    base = max(clean, key=len).replace("\n", " ")
    near = base.split()
    near[len(near) // 2] = "other"
    rows = [(1000 + i, t, "en", "s", len(t)) for i, t in enumerate(clean)]
    rows += [(1, base, "en", "s", 1), (2, base, "en", "s", 1), (3, " ".join(near), "en", "s", 1), (4, base[: len(base) // 2] + " " + item, "en", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, sf).collect()}
    assert 1 in kept and not kept & {2, 3}
    kept = {r["doc_id"] for r in corpus_pipeline.benchmark_leaks(spark, docs, sf).collect()}
    assert 4 not in kept and {1, 2, 3} <= kept


def test_empty_documents(spark, sf):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0


def test_stages_leave_only_small_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = set(os.listdir(shared_root(spark))) if os.path.isdir(shared_root(spark)) else set()
    corpus_pipeline.quality_rules(spark, docs, sf)
    corpus_pipeline.near_duplicates(spark, docs, sf)
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(shared_root(spark))) - before}
    assert left == {"quality-rows", "ngram-components"}
