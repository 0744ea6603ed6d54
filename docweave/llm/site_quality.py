"""Quality by hierarchical empirical Bayes: what a text says, its path's and its host's other texts.

A logistic classifier of text statistics gives every document its evidence. Documents are grouped by host and by path
inside the host (two grouped aggregations that combine before the shuffle). How far groups really differ is estimated from
the data by variance components, within against between: their ratio is the number of documents that a
group's prior is worth. A host's rate is shrunk towards the rate of all, a path's towards its host's, so a sparse site says
little and a large one speaks for itself. A document is left out of the rates it is judged by. Its final odds
are its evidence with the classifier's prior exchanged for its path's posterior.

Training uses at most ``SAMPLE_DOCS`` labelled documents of each label that are not held out, the smallest hashes of
their ids; each label is weighted back to its share.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from docweave.llm.toxicity import held_out
from docweave.llm.words import text_chunks
from docweave.session import materialize

SAMPLE_DOCS = 2_500
THRESHOLD = 0.5
RIDGE = 1e-2
STEPS = 30
MOST_STRENGTH = 1e6
_UPPER, _DIGITS, _SYMBOLS, _POINTS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>", b".,;:!?"
FEATURES = ("words", "length", "upper", "digits", "symbols", "points", "shouts", "distinct", "top", "lines", "repeats")


def text_features(text: bytes | None) -> list[float]:
    """Statistics of a text, all about 0 to 5; zeros for a text without words."""
    words = text.split() if text else []
    if not words:
        return [0.0] * len(FEATURES)
    n, size = len(words), sum(map(len, words))

    def share(chars: bytes) -> float:
        return 10 * (len(text) - len(text.translate(None, chars))) / size

    counts = Counter(words)
    lines = text.split(b"\n")
    return [
        np.log10(n),
        size / n / 5,
        share(_UPPER),
        share(_DIGITS),
        share(_SYMBOLS),
        share(_POINTS),
        10 * text.count(b"!!") / n,
        len(counts) / n,
        max(counts.values()) / n,
        5 * len(lines) / n,
        1 - len(set(lines)) / len(lines),
    ]


class Logistic:
    """Weights over standardised features."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, prior: float):
        self.mean, self.scale, self.weights, self.prior = mean, scale, weights, prior

    @classmethod
    def train(cls, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Logistic:
        """Newton steps on the weighted ridge loss."""
        size = len(FEATURES)
        if not len(y) or y.min() == y.max():
            rate = float(np.clip(y.mean() if len(y) else 0.5, 0.02, 0.98))
            start = np.append(np.zeros(2 * size), np.log(rate / (1 - rate)))
            return cls(np.zeros(size), np.ones(size), start, rate)
        mean, scale = x.mean(0), x.std(0) + 1e-6
        z = cls._design((x - mean) / scale)
        weight = weight / weight.sum()
        prior = float((weight * y).sum())
        w = np.zeros(z.shape[1])
        w[-1] = np.log(prior / (1 - prior))
        penalty = np.full(len(w), RIDGE / 10)
        penalty[-1] = 0
        for _ in range(STEPS):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            slope = z.T @ (weight * (p - y)) + penalty * w
            curve = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-9)
            w = w - np.linalg.solve(curve, slope)
        return cls(mean, scale, w, prior)

    @staticmethod
    def _design(z: np.ndarray) -> np.ndarray:
        z = np.clip(z, -6, 6)
        return np.concatenate([z, z * z / 4, np.ones((len(z), 1))], axis=1)

    def evidence(self, x: np.ndarray) -> np.ndarray:
        """Log odds of good quality."""
        return np.clip(self._design((x - self.mean) / self.scale) @ self.weights, -8, 8)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, texts in text_chunks(batch, "text"):
            rows = [text_features(t) for t in texts]
            yield pa.record_batch(
                [batch.column("quality").slice(first, len(texts)), pa.array(rows, pa.list_(pa.float64()))],
                names=["quality", "x"],
            )


def fit(documents: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Logistic:
    """Train on labelled documents that are not held out; labels that repeat for a document count once."""
    known = labels.select("doc_id", "quality").dropna().filter("quality in (0, 1)").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    counts = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    sides = [known.filter(F.col("quality") == q).orderBy(*order).limit(sample_docs) for q in (0, 1)]
    chosen = sides[0].union(sides[1])  # at most 2 * sample_docs rows
    picked = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    table = picked.select("quality", "text").mapInArrow(_features, "quality int, x array<double>").toArrow()
    y = np.array(table.column("quality").to_pylist(), float)
    x = np.array(table.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
    have = {q: max(int((y == q).sum()), 1) for q in (0, 1)}
    return Logistic.train(x, y, np.array([counts.get(int(q), 0) / have[int(q)] for q in y]))


def _evidence(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for first, texts in text_chunks(batch, "text"):
                found = model.evidence(np.array([text_features(t) for t in texts]).reshape(-1, len(FEATURES)))
                own = [batch.column(c).slice(first, len(texts)) for c in ("doc_id", "site", "path")]
                yield pa.record_batch([*own, pa.array(found)], names=["doc_id", "site", "path", "evidence"])

    return run, "doc_id long, site string, path string, evidence double"


def strength(within: float, between: float) -> float:
    """Documents that a prior is worth: variance inside of groups to variance between them."""
    if between <= 0:
        return MOST_STRENGTH
    return float(np.clip(within / between, 1e-3, MOST_STRENGTH))


def variance_components(paths: DataFrame) -> tuple[float, float, float]:
    """(rate of all, strength of the prior of hosts, of paths) from per-path sums; one row comes to the driver."""
    sites = paths.groupBy("site").agg(
        F.sum("n").alias("n"),
        F.sum("s").alias("s"),
        F.sum(F.col("s") * F.col("s") / F.col("n")).alias("path_fit"),
        F.sum("q").alias("q"),
        F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.count(F.lit(1)).alias("paths"),
    )
    row = sites.agg(
        F.sum("n").alias("n"),
        F.sum("s").alias("s"),
        F.sum("q").alias("q"),
        F.sum(F.col("s") * F.col("s") / F.col("n")).alias("site_fit"),
        F.sum("path_fit").alias("path_fit"),
        F.sum(F.col("n") * F.col("n")).alias("site_nn"),
        F.sum(F.col("nn") / F.col("n")).alias("path_nn"),
        F.count(F.lit(1)).alias("sites"),
        F.sum("paths").alias("paths"),
    ).first()
    n = row["n"] or 0
    if not n:
        return 0.5, MOST_STRENGTH, MOST_STRENGTH
    rate = row["s"] / n

    def ratio(total: float, fine: float, coarse: float, groups: int, above: int, spread: float) -> float:
        within = max(total - fine, 0.0) / max(n - groups, 1)
        between = (fine - coarse - (groups - above) * within) / spread if spread > 1e-9 and groups > above else 0.0
        return strength(within, between)

    of_sites = ratio(row["q"], row["site_fit"], row["s"] ** 2 / n, row["sites"], 1, n - row["site_nn"] / n)
    of_paths = ratio(row["q"], row["path_fit"], row["site_fit"], row["paths"], row["sites"], n - row["path_nn"])
    return float(rate), of_sites, of_paths


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-4)), F.lit(1 - 1e-4))
    return F.log(p / (1 - p))


def score_quality(
    documents: DataFrame, labels: DataFrame, site: Column | None = None, path: Column | None = None, sample_docs: int = SAMPLE_DOCS
) -> DataFrame:
    """Per row: doc_id, held_out, evidence (log odds of the text alone), site_rate and path_rate (posteriors without the
    row itself), score and ``kept`` (score of at least ``THRESHOLD``).

    ``site`` and ``path`` say where a document comes from; by default its source, and its language inside. Null is a
    site or path of its own. Texts without words have the evidence the classifier gives them. Rows that repeat
    count as often as they come. Without labels of both kinds the evidence is the same for all. No rows in, no rows out.
    """
    where = documents.select(
        "doc_id",
        (F.col("source") if site is None else site).cast("string").alias("site"),
        (F.col("lang") if path is None else path).cast("string").alias("path"),
        "text",
    )
    model = fit(documents, labels, sample_docs)
    shared = documents.sparkSession.sparkContext.broadcast(model)  # some dozen weights
    run, schema = _evidence(shared)
    rows = materialize(where.mapInArrow(run, schema), "quality-evidence")
    rows = rows.withColumn("p", 1 / (1 + F.exp(-F.col("evidence"))))
    paths = rows.groupBy("site", "path").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("q")
    )
    paths = materialize(paths, "quality-paths")
    rate, of_sites, of_paths = variance_components(paths)
    sites = paths.groupBy(F.col("site").alias("_site")).agg(F.sum("n").alias("_site_n"), F.sum("s").alias("_site_s"))
    rates = paths.join(sites, F.col("site").eqNullSafe(F.col("_site")))
    rates = rates.select(
        F.col("site").alias("_at"), F.col("path").alias("_in"), F.col("n").alias("_n"), F.col("s").alias("_s"), "_site_n", "_site_s"
    )
    # as many rows as paths, which may be many: a shuffled join, whose hot sites adaptive execution splits
    joined = rows.join(rates, F.col("site").eqNullSafe(F.col("_at")) & F.col("path").eqNullSafe(F.col("_in")))
    of_site = (F.col("_site_s") - F.col("p") + of_sites * rate) / (F.col("_site_n") - 1 + of_sites)
    joined = joined.withColumn("site_rate", F.least(F.greatest(of_site, F.lit(0.0)), F.lit(1.0)))
    of_path = (F.col("_s") - F.col("p") + of_paths * F.col("site_rate")) / (F.col("_n") - 1 + of_paths)
    joined = joined.withColumn("path_rate", F.least(F.greatest(of_path, F.lit(0.0)), F.lit(1.0)))
    odds = F.col("evidence") - _logit(F.lit(model.prior)) + _logit(F.col("path_rate"))
    score = 1 / (1 + F.exp(-odds))
    return joined.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "evidence",
        "site_rate",
        "path_rate",
        score.alias("score"),
        (score >= THRESHOLD).alias("kept"),
    )


def keep_good(documents: DataFrame, labels: DataFrame, **where) -> DataFrame:
    """The documents that are kept, all columns; of rows that share an id all stay if one does. Rows without id go."""
    good = score_quality(documents, labels, **where).filter("kept").select(F.col("doc_id").alias("_good")).distinct()
    return documents.join(good, F.col("doc_id") == F.col("_good"), "left_semi")


def url_site(url: Column) -> Column:
    """Host of a URL, without case."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """First directory of a URL's path."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]*)/", 1)
