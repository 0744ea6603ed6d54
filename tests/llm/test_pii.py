import hashlib
import random
import re

import numpy as np
import pytest

from docweave.llm import pii as P
from docweave.llm.tagger import Tagger
from llm.conftest import EDGE_TEXTS


def luhn(digits):
    doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(digits[::-1])]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def brute(text):
    text, spans = text or "", []
    spans += [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            spans.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            spans.append((m.start(), 3, m.end()))
    return sorted(spans)


TEXTS = [
    *EDGE_TEXTS,
    "é a.b@c.de, x@y @z.com a@b.c@d.e .@-.-. q@w..e u@v.w.",
    "1.2.3.4.5.6.7.8 256.1.1.1 0001.002.3.4 1.2.3 9.9.9.999 00000000255.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112 0000000000000000000 00000000000000000000 12",
    "+1 (234) 555-6789 +12 345 +1.2.3.4.5.6.7.8.9 ++49 30 1234567 +1234567890123456",
]


def random_text(rng):
    return "".join(rng.choice("ab1.2@+- ()59é\n") for _ in range(rng.randrange(0, 120)))


def test_patterns_agree_with_their_definition():
    rng = random.Random(1)
    for text in [t for t in TEXTS if t] + [random_text(rng) for _ in range(3000)]:
        assert P.base_spans(text) == brute(text), text[:80]


def test_long_runs_take_linear_time():
    for text in ("x" * 200_000 + "@", "1" * 200_000, "+" * 200_000, "1." * 100_000, "@" * 100_000):
        P.base_spans(text)


@pytest.fixture
def quick(monkeypatch):
    monkeypatch.setattr(P, "EPOCHS", 1)
    monkeypatch.setattr(P.fit, "__defaults__", (1, 60, 5))
    monkeypatch.setattr(P.find_pii, "__defaults__", (None, 1))


def test_digest_of_texts(docs, quick):
    got = {r["doc_id"]: r for r in P.pii_digest(docs(list(enumerate(TEXTS)))).collect()}
    for i, text in enumerate(TEXTS):
        spans = brute(text)
        listed = ",".join(f"{P.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert [got[i][f"n_{k}"] for k in P.KINDS] == [sum(s[1] == k for s in spans) for k in range(4)]
        assert got[i]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(filter(None, got[i]["spans"].split(",")))


def test_tagger_learns_held_out_spans(spark, sf):
    rows = spark.read.parquet(f"{sf.replace('0.001', '0.1')}/documents.parquet").select("text").collect()
    texts = [r["text"] for r in rows if re.search("[0-9@]", r["text"])]
    data = [(P.spell(P.base_spans(t)), P.regions(t)) for t in texts]
    full = [d for d in data if d[0]]
    tagger = P.fit(full[: len(full) // 2] + [d for d in data if not d[0]][:200])
    hits = wrong = missed = 0
    for listed, parts in full[len(full) // 2 :]:
        true = set(P.unspell(listed))
        found = {
            (at + a, k, at + b) for (at, part), spans in zip(parts, P.decode(tagger, [p for _, p in parts])) for a, k, b in spans
        }
        hits, wrong, missed = hits + len(true & found), wrong + len(found - true), missed + len(true - found)
    assert hits / (hits + missed) > 0.75 and hits / (hits + wrong) > 0.85


def test_slopes_of_the_crf():
    rng = np.random.default_rng(0)
    tagger = Tagger(2, hidden=4)
    for k in ("step", "first"):
        tagger.p[k] = rng.normal(0, 1, tagger.p[k].shape)
    gold = np.array([[0, 1, 0], [1, 2, 0], [2, 2, 3], [0, 0, 4]])
    e = rng.normal(0, 1, (4, 3, 5))
    loss, slope, _, _ = tagger._loss(e, gold)
    for t, n, k in ((0, 0, 0), (2, 1, 2), (3, 2, 4)):
        moved = e.copy()
        moved[t, n, k] += 1e-5
        assert (tagger._loss(moved, gold)[0] - loss) / 1e-5 == pytest.approx(slope[t, n, k], abs=1e-4)


def test_windows_are_reconciled_over_long_regions():
    tagger = Tagger(4, hidden=4)
    parts = ["1" * 5000, "2", "3" * 47, "4" * 48, "5" * 49]
    for part, spans in zip(parts, P.decode(tagger, parts)):
        assert all(0 <= a < b <= len(part) for a, _, b in spans)
        assert all(x[2] <= y[0] for x, y in zip(spans, spans[1:]))
    assert P._spans_of(np.array([0, 1, 2, 2, 1, 2, 0, 3, 4, 5])) == [(1, 0, 4), (4, 0, 6), (7, 1, 9), (9, 2, 10)]


def test_empty_table_nulls_and_given_labels(spark, docs, quick):
    df = docs([(None, "write to a.b@c.de"), (1, None), (1, None)]).withColumnRenamed("n_chars", "base")
    assert sorted((r["doc_id"] or 0, r["n_email"]) for r in P.find_pii(df).collect()) == [(0, 1), (1, 0), (1, 0)]
    labelled = spark.createDataFrame([("call 12345 now", "phone:5:10"), (None, None)], "text string, spans string")
    assert P.find_pii(df, labelled).count() == 3
    assert P.pii_digest(docs([])).count() == 0
    assert P.pii_digest(docs([(1, "no data at all")])).first()["spans"] == ""
