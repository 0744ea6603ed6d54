import random

import numpy as np

from docweave.llm import decontaminate as D
from llm.conftest import EDGE_TEXTS

ITEM_SCHEMA = "item_id long, text string"


def edited(words, edits, rng):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        kind = rng.random()
        if kind < 0.4:
            words[at] = f"new{rng.randrange(999)}"
        elif kind < 0.7:
            words.insert(at, f"more{rng.randrange(999)}")
        elif len(words) > 1:
            del words[at]
    return words


def distance(item, text):
    """Least edits between the item and any part of the text, by definition."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        now = [i]
        for j, b in enumerate(text, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (a != b)))
        row = now
    return min(row)


def test_passage_is_the_nearest(noise):
    rng = random.Random(5)
    for trial in range(40):
        item = [rng.randrange(6) for _ in range(rng.randrange(1, 12))]
        text = [rng.randrange(6) for _ in range(rng.randrange(1, 25))]
        edits, begin, end = D.best_passage(np.array(item), np.array(text))
        assert edits == distance(item, text)
        part = text[begin:end]
        full = list(range(len(part) + 1))
        for i, a in enumerate(item, 1):
            now = [i]
            for j, b in enumerate(part, 1):
                now.append(min(full[j] + 1, now[-1] + 1, full[j - 1] + (a != b)))
            full = now
        assert full[-1] == edits


def test_recall_and_precision_against_brute_force(spark, docs, noise):
    rng = random.Random(11)
    items = [noise(rng.randrange(5, 60), 900 + i) for i in range(40)]
    rows = []
    for i in range(160):
        item = items[i % 40]
        k = D.allowed(len(item))
        passage = edited(item, rng.choice([0, k // 2, k, k + 2, 2 * k + 3]), rng)
        around = noise(80, 3000 + i)
        rows.append((i, " ".join(around[:40] + passage + around[40:])))
    rows += [(1000 + i, " ".join(noise(150, 7000 + i))) for i in range(40)]
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], ITEM_SCHEMA)
    found = {(r["doc_id"], r["item_id"]) for r in D.find_leaks(docs(rows), benchmark).collect()}
    true = set()
    for doc, text in rows:
        words = text.split()
        for i, item in enumerate(items):
            if set(item) & set(words) and distance(item, words) <= D.allowed(len(item)):
                true.add((doc, i))
    assert found <= true
    assert len(found) >= 0.99 * len(true) and len(true) > 80


def test_recall_of_long_items_at_full_edits(noise):
    rng = random.Random(12)
    for n, trials in [(20, 60), (33, 60), (60, 60), (150, 30), (300, 20), (600, 10)]:
        found = 0
        for i in range(trials):
            item = noise(n, 10_000 + 100 * n + i)
            text = noise(50, i) + edited(item, D.allowed(n), rng) + noise(50, 500 + i)
            index = D.ItemIndex([7], [" ".join(item).encode()])
            codes, starts, _ = D.item_words([" ".join(text).encode()], D.WordCache(D.normal_word))
            found += bool(index.search(codes, starts))
        assert found >= 0.98 * trials, n


def test_short_items_match_exactly(spark, docs, noise):
    benchmark = spark.createDataFrame([(1, "alpha"), (2, "beta gamma delta omega"), (3, "...")], ITEM_SCHEMA)
    around = " ".join(noise(10))
    texts = [f"{around} Alpha, {around}", f"{around} beta gamma delta omega", f"{around} beta gamma omega", "beta gamma delta"]
    found = D.find_leaks(docs(list(enumerate(texts))), benchmark).collect()
    assert sorted((r["doc_id"], r["item_id"], r["edits"], r["begin"], r["end"]) for r in found) == [(0, 1, 0, 10, 11), (1, 2, 0, 10, 14)]


def test_report_spans_case_punctuation_and_slices(spark, docs, noise):
    item = noise(12, 1)
    text = " ".join(noise(5, 2)) + "\n" + " ".join(w.upper() + "," for w in item) + " | end"
    benchmark = spark.createDataFrame([(7, " ".join(item)), (8, "too short"), (None, " ".join(item)), (9, None)], ITEM_SCHEMA)
    rows = {r["doc_id"]: r for r in D.leak_report(docs([(1, text), (2, "clean " * 20)]), benchmark).collect()}
    assert rows[1]["leaked"] and rows[1]["item_ids"] == [7] and rows[1]["passages"] == "7:5:17"
    assert not rows[2]["leaked"] and rows[2]["item_ids"] == []
    many = spark.createDataFrame([(i, " ".join(noise(12, i))) for i in range(20)], ITEM_SCHEMA)
    found = D.find_leaks(docs([(1, text)]), many, slice_words=10).collect()
    assert [(r["item_id"], r["edits"], r["begin"], r["end"]) for r in found] == [(1, 0, 5, 17)]


def test_edge_rows_and_empty_tables(spark, docs, noise):
    item = " ".join(noise(10))
    benchmark = spark.createDataFrame([(1, item)], ITEM_SCHEMA)
    df = docs([*enumerate(EDGE_TEXTS), (None, item), (50, item), (50, item)]).withColumnRenamed("n_chars", "item_id")
    report = D.leak_report(df, benchmark)
    assert report.count() == len(EDGE_TEXTS) + 3
    assert {r["doc_id"] for r in report.filter("leaked").collect()} == {50}
    kept = D.drop_leaking(df, benchmark)
    assert kept.columns == df.columns and kept.count() == len(EDGE_TEXTS) + 1
    assert D.leak_report(df, benchmark.limit(0)).filter("leaked").count() == 0
    assert D.leak_report(docs([]), benchmark).count() == 0
