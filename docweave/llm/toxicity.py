"""Toxicity by multiple-instance learning: sentences are scored, only documents are labelled.

A sentence's probability is logistic in its distinct words; a document's is the leaky noisy-or of its
sentences, ``1 - (1 - leak) * prod(1 - p)``. The leak is trained too: it stands for labels that no
sentence explains, so that these don't teach the words around them. Features are the words whose log odds
ratio with the label is more than ``EVIDENCE`` standard errors from zero, which is also where their weights start. The weights are trained through the noisy-or from document labels, so the blame
for a label settles on the sentences that explain it, which are then located. A word is taken without case and the
punctuation around it; sentences end at ``.``, ``!``, ``?`` at the end of a word, and at line ends.

Training uses a bounded sample: at most ``SAMPLE_DOCS`` labelled documents of each label, those with the
smallest hash of their id; each side is weighted back to its share of all labelled documents. Scoring reads every text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from docweave.llm.words import WordCache, text_chunks, word_code

SAMPLE_DOCS = 2_500
FEATURE_BITS = 18
LEAST_TEXTS = 4
EVIDENCE = 2.5
ROUNDS = 150
RATE = 0.1
RIDGE = 1e-5
HELD_OUT, FOLDS = 2, 4
THRESHOLD = 0.3
SENTENCE_THRESHOLD = 0.5
_EDGES = " \t\n\r\x0b\x0c.,;:!?\"'()[]{}|*$%&#<>_-"
_LINE_END = b"\x01"


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of training: crc32 of its id as text."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def feature(word: bytes) -> int:
    """Twice the number of a word's feature, and one more if it ends a sentence. Feature 0: no word."""
    if word == _LINE_END:
        return 1
    bare = word.decode().strip(_EDGES).lower()
    ends = word[-1:] in b".!?"
    number = 1 + word_code(bare.encode()) % ((1 << FEATURE_BITS) - 1) if bare else 0
    return 2 * number + ends


def sentences(texts: list[bytes | None], cache: WordCache) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (sentence, feature) pairs of texts, and how many sentences each text has."""
    words: list[bytes] = []
    starts = [0]
    for text in texts:
        if text:
            words += text.replace(b"\n", b" \x01 ").split()
            words.append(_LINE_END)
        starts.append(len(words))
    marks = np.fromiter(map(cache.__getitem__, words), np.int64, len(words))
    ends = marks & 1
    sentence = np.cumsum(ends) - ends
    last = np.concatenate([[0], np.cumsum(ends)])[np.array(starts)]
    number = marks >> 1
    pairs = np.unique((sentence * (1 << FEATURE_BITS) + number)[number > 0])
    return pairs >> FEATURE_BITS, pairs & ((1 << FEATURE_BITS) - 1), np.diff(last)


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled texts as bytes of their sentences and features."""
    cache = WordCache(feature)
    for batch in batches:
        for first, texts in text_chunks(batch, "text"):
            sentence, number, counts = sentences(texts, cache)
            cuts = np.searchsorted(sentence, np.concatenate([[0], np.cumsum(counts)]))
            base = np.cumsum(counts) - counts
            rows = [
                ((sentence[a:b] - s).astype(np.int32).tobytes(), number[a:b].astype(np.int32).tobytes())
                for a, b, s in zip(cuts[:-1], cuts[1:], base)
            ]
            yield pa.record_batch(
                [
                    batch.column("toxic").slice(first, len(texts)),
                    pa.array([r[0] for r in rows], pa.binary()),
                    pa.array([r[1] for r in rows], pa.binary()),
                ],
                names=["toxic", "sentence", "feature"],
            )


class NoisyOr:
    """Weights of the sentence model."""

    def __init__(self, weights: np.ndarray, bias: float, leak: float = -30.0):
        self.weights, self.bias, self.leak = weights, bias, leak

    @staticmethod
    def _log_not(z: np.ndarray) -> np.ndarray:
        """log(1 - logistic(z))"""
        return -np.logaddexp(0, z)

    @staticmethod
    def _association(pairs: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log odds ratio of each feature with the label, from distinct (text, feature) pairs, and its standard error."""
        size = 1 << FEATURE_BITS
        text, number = pairs >> FEATURE_BITS, pairs & (size - 1)
        toxic = np.bincount(number, weights=labels[text], minlength=size) + 0.5
        clean = np.bincount(number, weights=1 - labels[text], minlength=size) + 0.5
        n1, n0 = labels.sum() + 1 - toxic, len(labels) - labels.sum() + 1 - clean
        error = np.sqrt(1 / toxic + 1 / clean + 1 / n1 + 1 / n0)
        few = toxic + clean < LEAST_TEXTS + 1
        return np.where(few, 0.0, np.log(toxic * n0 / (clean * n1))), error

    @classmethod
    def train(cls, bags: list[tuple[int, np.ndarray, np.ndarray]], shares: dict[int, float]) -> NoisyOr:
        """``bags``: (label, sentence of each entry, feature of each entry)."""
        if not bags or len({label for label, _, _ in bags}) < 2:
            rate = float(np.mean([label for label, _, _ in bags])) if bags else 0.0
            rate = min(max(rate, 1e-3), 1 - 1e-3)
            return cls(np.zeros(1 << FEATURE_BITS, np.float32), float(np.log(rate / (1 - rate))))
        labels = np.array([b[0] for b in bags], float)
        bag_weight = np.array([shares[int(x)] for x in labels])
        bag_weight /= bag_weight.sum()
        number = np.concatenate([b[2] for b in bags]).astype(np.int64)
        bag = np.repeat(np.arange(len(bags)), [len(b[2]) for b in bags])
        odds, error = cls._association(np.unique(bag * (1 << FEATURE_BITS) + number), labels)
        known = np.flatnonzero(np.abs(odds) > EVIDENCE * error)
        place = np.full(1 << FEATURE_BITS, -1)
        place[known] = np.arange(len(known))
        most = [int(b[1].max()) + 1 if len(b[1]) else 1 for b in bags]
        base = np.cumsum(most) - most
        sentence = np.concatenate([b[1] for b in bags]).astype(np.int64) + base[bag]
        used = place[number] >= 0
        column, row = place[number[used]], sentence[used]
        of_bag = np.repeat(np.arange(len(bags)), most)
        n_rows = int(sum(most))
        w, bias, leak = odds[known], -6.0, -3.0
        m = v = np.zeros(len(known) + 2)
        for step in range(1, ROUNDS + 1):
            z = np.bincount(row, weights=w[column], minlength=n_rows) + bias
            log_not = cls._log_not(z)
            total = np.bincount(of_bag, weights=log_not, minlength=len(bags)) + cls._log_not(leak)
            toxic = np.clip(-np.expm1(total), 1e-9, 1.0)
            # gradient of the log loss by each sentence's z
            pull = np.where(labels > 0, -(1 - toxic) / toxic, 1.0) * bag_weight
            slope = pull[of_bag] * -np.expm1(log_not)
            by_word = np.bincount(column, weights=slope[row], minlength=len(known)) + RIDGE * w
            leaked = pull.sum() * -np.expm1(cls._log_not(leak))
            gradient = np.concatenate([by_word, [slope.sum(), leaked]])
            m = 0.9 * m + 0.1 * gradient
            v = 0.99 * v + 0.01 * gradient**2
            change = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            change *= 1 - step / (ROUNDS + 1)
            w, bias, leak = w - change[:-2], bias - change[-2], leak - change[-1]
        weights = np.zeros(1 << FEATURE_BITS, np.float32)
        weights[known] = w
        return cls(weights, float(bias), float(leak))

    def sentence_scores(self, sentence: np.ndarray, number: np.ndarray, count: int) -> np.ndarray:
        return np.bincount(sentence, weights=self.weights[number], minlength=count) + self.bias


def fit(documents: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> NoisyOr:
    """Train on labelled documents that are not held out; repeated labels of a document count once."""
    known = labels.select("doc_id", "toxic").dropna().filter(~held_out(F.col("doc_id"))).filter("toxic in (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    sides = [known.filter(F.col("toxic") == t).orderBy(*order).limit(sample_docs) for t in (0, 1)]
    chosen = sides[0].union(sides[1])  # at most 2 * sample_docs rows
    picked = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    table = picked.select("toxic", "text").mapInArrow(_bags, "toxic int, sentence binary, feature binary").toArrow()
    bags = [
        (t, np.frombuffer(s, np.int32), np.frombuffer(f, np.int32))
        for t, s, f in zip(*(table.column(c).to_pylist() for c in ("toxic", "sentence", "feature")))
    ]
    have = {t: sum(b[0] == t for b in bags) for t in (0, 1)}
    return NoisyOr.train(bags, {t: counts.get(t, 0) / max(have[t], 1) for t in (0, 1)})


def _score(shared):
    columns = ["doc_id", "score", "n_sentences", "offending"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, cache = shared.value, WordCache(feature)
        limit = np.log(SENTENCE_THRESHOLD / (1 - SENTENCE_THRESHOLD))
        for batch in batches:
            for first, texts in text_chunks(batch, "text"):
                sentence, number, counts = sentences(texts, cache)
                z = model.sentence_scores(sentence, number, int(counts.sum()))
                ends = np.concatenate([[0], np.cumsum(counts)])
                sums = np.concatenate([[0.0], np.cumsum(model._log_not(z))])
                score = -np.expm1(sums[ends[1:]] - sums[ends[:-1]] + model._log_not(model.leak))
                bad = np.flatnonzero(z >= limit)
                cuts = np.searchsorted(bad, ends)
                where = [(bad[a:b] - s).tolist() for a, b, s in zip(cuts[:-1], cuts[1:], ends[:-1])]
                yield pa.record_batch(
                    [
                        batch.column("doc_id").slice(first, len(texts)),
                        pa.array(np.clip(score, 0.0, 1.0)),
                        pa.array(counts),
                        pa.array(where, pa.list_(pa.int64())),
                    ],
                    names=columns,
                )

    return run, "doc_id long, score double, n_sentences long, offending array<long>"


def score_toxicity(documents: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted, n_sentences and ``offending``, the numbers of the sentences
    (from 0, line ends count as sentence ends) whose own probability reaches ``SENTENCE_THRESHOLD``.

    A null or empty text has no sentence and scores the leak. A null id is not held out and never learnt from. Without
    labels of both kinds every sentence gets their rate. Rows that repeat score alike. No rows in, no rows out.
    """
    slim = documents.select("doc_id", "text")
    shared = slim.sparkSession.sparkContext.broadcast(fit(slim, labels, sample_docs))  # 1 MB of weights
    run, schema = _score(shared)
    scored = slim.mapInArrow(run, schema)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "n_sentences",
        "offending",
    )
