"""Personal data: fixed patterns, and a character BiLSTM-CRF trained from labelled spans.

The tagger learns from spans; without others, those of the patterns in a bounded sample are the labels (at most
``SAMPLE_ROWS`` texts with a span and as many without, by the hash of their id; ``TRAIN_WINDOWS`` windows). Every
kind of personal data here holds a digit or an ``@``, so text further than ``MARGIN`` characters from both can't belong to a
span and isn't decoded: that is a filter on the kinds, not a sample. The rest of every text, its *regions*, is cut into windows
of ``WIDTH`` characters that overlap by half. A character's tag scores are the mean over its windows, weighted by how far
inside of each it lies, and one Viterbi pass over the whole region reconciles them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docweave.llm.tagger import Tagger, sign_ids
from docweave.llm.words import text_chunks
from docweave.session import materialize

KINDS = ("email", "ip", "card", "phone")
MARGIN = 24
WIDTH = 48
SAMPLE_ROWS = 400
TRAIN_WINDOWS = 1_500
EPOCHS = 24
HIDDEN = 24
LEAST_CHARS = 5
_BATCH_CHARS = 100_000

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SIGNAL = re.compile(r"[0-9@](?:[^0-9@]{0,%d}[0-9@])*" % (2 * MARGIN))
_NO_DIGIT = bytes(i for i in range(256) if chr(i) not in "0123456789@")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the longest run of local characters before an ``@`` that a domain follows."""
    done, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at)
        start = at
        if domain:
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                done = domain.end()
                yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the patterns, in order."""
    spans = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            spans.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and _luhn(digits):
            spans.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def regions(text: str) -> list[tuple[int, str]]:
    """(start, part): the parts of a text within ``MARGIN`` characters of a digit or ``@``."""
    out = []
    for m in _SIGNAL.finditer(text):
        a, b = max(0, m.start() - MARGIN), min(len(text), m.end() + MARGIN)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, text[a:b]) for a, b in out]


def spell(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def unspell(text: str) -> list[tuple[int, int, int]]:
    return [(int(a), KINDS.index(k), int(b)) for k, a, b in (s.split(":") for s in text.split(",") if s)]


_ROWS = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base string, regions array<struct<at: long, part: string>>"
_PARTS = pa.list_(pa.struct([("at", pa.int64()), ("part", pa.string())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, texts in text_chunks(batch, "text"):
            spans, parts = [], []
            for text in texts:
                if text and text.translate(None, _NO_DIGIT):
                    decoded = text.decode()
                    spans.append(base_spans(decoded))
                    parts.append([{"at": a, "part": p} for a, p in regions(decoded)])
                else:
                    spans.append([])
                    parts.append([])
            counts = [pa.array([sum(s[1] == k for s in row) for row in spans], pa.int64()) for k in range(len(KINDS))]
            yield pa.record_batch(
                [
                    batch.column("doc_id").slice(first, len(texts)),
                    *counts,
                    pa.array([spell(row) for row in spans], pa.string()),
                    pa.array(parts, _PARTS),
                ],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base", "regions"],
            )


def cut(length: int) -> list[int]:
    """Where the overlapping windows of a region begin."""
    return list(range(0, max(1, length - WIDTH // 2), WIDTH // 2))


def _tags(at: int, length: int, spans: list[tuple[int, int, int]]) -> np.ndarray:
    tags = np.zeros(length, np.int64)
    for a, k, b in spans:
        lo, hi = max(a - at, 0), min(b - at, length)
        if lo < hi and not tags[lo:hi].any():
            tags[lo:hi] = 2 * k + 2
            if a >= at:
                tags[lo] = 2 * k + 1
    return tags


def fit(rows: list[tuple[str, list[tuple[int, str]]]], epochs: int = EPOCHS, windows: int = TRAIN_WINDOWS, seed: int = 5) -> Tagger | None:
    """Train from (labelled spans, regions) of some texts; None without any span."""
    x, gold = [], []
    for listed, parts in rows:
        spans = unspell(listed)
        for at, part in parts:
            ids, tags = sign_ids(part), _tags(at, len(part), spans)
            for start in cut(len(part)):
                own = slice(start, start + WIDTH)
                pad = WIDTH - len(ids[own])
                x.append(np.pad(ids[own], (0, pad)))
                gold.append(np.pad(tags[own], (0, pad)))
    if not any(g.any() for g in gold):
        return None
    x, gold = np.array(x), np.array(gold)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    full = gold[order].any(axis=1)
    chosen = np.concatenate([order[full][: 2 * windows // 3], order[~full][: windows // 3]])
    x, gold = x[chosen], gold[chosen]
    begun = (gold[:, 0] > 0) & (gold[:, 0] % 2 == 0)
    gold[begun, 0] -= 1  # a window may begin inside of a span
    tagger = Tagger(len(KINDS), HIDDEN, seed)
    tagger.train(x, gold, epochs, seed=seed)
    return tagger


def decode(tagger: Tagger, parts: list[str]) -> list[list[tuple[int, int, int]]]:
    """(start, kind, end) spans inside each region."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in parts]
    order = sorted(range(len(parts)), key=lambda i: -len(parts[i]))
    a = 0
    while a < len(order):
        longest, b = len(parts[order[a]]), a + 1
        while b < len(order) and longest * (b - a + 1) <= _BATCH_CHARS:
            b += 1
        chosen = order[a:b]
        lengths = np.array([len(parts[i]) for i in chosen])
        owner, begin, windows = [], [], []
        for j, i in enumerate(chosen):
            ids = sign_ids(parts[i])
            for start in cut(len(ids)):
                window = ids[start : start + WIDTH]
                windows.append(np.pad(window, (0, WIDTH - len(window))))
                owner.append(j)
                begin.append(start)
        scores = tagger.emissions(np.array(windows).T)
        inside = np.minimum(np.arange(WIDTH), np.arange(WIDTH)[::-1]) + 1.0
        sums = np.zeros((longest + WIDTH, len(chosen), tagger.tags), np.float32)
        weight = np.zeros((longest + WIDTH, len(chosen)), np.float32)
        owner, begin = np.array(owner), np.array(begin)
        for t in range(WIDTH):
            np.add.at(sums, (begin + t, owner), scores[t] * inside[t])
            np.add.at(weight, (begin + t, owner), inside[t])
        merged = sums[:longest] / np.maximum(weight[:longest], 1e-6)[:, :, None]
        for j, tags in enumerate(tagger.best_tags(merged, lengths)):
            found[chosen[j]] = _spans_of(tags)
        a = b
    return found


def _spans_of(tags: np.ndarray) -> list[tuple[int, int, int]]:
    edges = np.flatnonzero((tags[1:] != tags[:-1]) & ~((tags[1:] == tags[:-1] + 1) & (tags[:-1] % 2 == 1)) | (tags[1:] % 2 == 1)) + 1
    cuts = [0, *edges.tolist(), len(tags)]
    return [(a, (int(tags[a]) - 1) // 2, b) for a, b in zip(cuts[:-1], cuts[1:]) if tags[a] > 0]


def _decode(shared):
    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = shared.value
        for batch in batches:
            bases, parts = batch.column("base").to_pylist(), batch.column("regions").to_pylist()
            flat = [r["part"] for row in parts for r in row]
            tagged = iter(decode(tagger, flat) if tagger is not None and flat else [[] for _ in flat])
            counts, spans = [], []
            for base, row in zip(bases, parts):
                known, new = unspell(base), []
                for region in row:
                    for a, k, b in next(tagged):
                        lo, hi = region["at"] + a, region["at"] + b
                        real = hi - lo >= LEAST_CHARS and any(c.isdigit() or c == "@" for c in region["part"][a:b])
                        if real and not any(x < hi and lo < y for x, _, y in known):
                            new.append((lo, k, hi))
                counts.append(len(new))
                spans.append(spell(sorted(known + new)))
            yield pa.record_batch(
                [*[batch.column(c) for c in names], pa.array(counts, pa.int64()), pa.array(spans, pa.string())],
                names=[*names, "n_added", "spans"],
            )

    return run, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base string, n_added long, spans string"


def find_pii(documents: DataFrame, labelled: DataFrame | None = None, epochs: int = EPOCHS) -> DataFrame:
    """Per row: doc_id, a count for each pattern, ``base``, ``n_added`` and ``spans`` as kind:start:end lists.

    ``labelled`` (text, spans) has texts with labelled spans in the same form; without it, the patterns' own spans
    are learnt. A null text is empty. Tagged spans that overlap one of a pattern are not added. Without any labelled span nothing is
    added. Rows that repeat are judged alike. No rows in, no rows out.
    """
    rows = materialize(documents.select("doc_id", "text").mapInArrow(_scan, _ROWS), "pii-regions")
    if labelled is None:
        order = (F.xxhash64("doc_id", "base"), F.col("doc_id"), F.col("base"))
        signal = rows.filter(F.size("regions") > 0)
        sample = [
            (r["base"], [(p["at"], p["part"]) for p in r["regions"]])
            for side in (signal.filter("base <> ''"), signal.filter("base = ''"))
            for r in side.orderBy(*order).limit(SAMPLE_ROWS).select("base", "regions").collect()  # a bounded sample
        ]
    else:
        sample = [(r["spans"], regions(r["text"])) for r in labelled.dropna().limit(2 * SAMPLE_ROWS).collect()]
    shared = rows.sparkSession.sparkContext.broadcast(fit(sample, epochs))  # some thousand weights
    run, schema = _decode(shared)
    return rows.mapInArrow(run, schema)


def pii_digest(documents: DataFrame) -> DataFrame:
    """The spans of the patterns as a hash, all spans as text."""
    found = find_pii(documents)
    return found.select(
        "doc_id", *[f"n_{k}" for k in KINDS], F.sha2("base", 256).alias("base_sha256"), "spans", "n_added"
    )
