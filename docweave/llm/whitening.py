"""Whiten embeddings by a covariance from polarisation, exact in whole numbers.

An entry c becomes the whole number ``x = floor(1024 c) + 100000``. Only squares are ever summed: of the centred
value of every dimension, and of the centred sum of every two dimensions. With ``u = n x - S`` (S the sum of the
dimension over all n vectors) these are ``D(i) = sum u_i^2`` and ``D(i,j) = sum (u_i + u_j)^2``, and the covariance
follows as ``(D(i,j) - D(i) - D(j)) / (2 n^3)``. Nothing is rounded before that division.

Tasks centre on the whole number nearest to the mean, so that squares stay small, and give one total for each dimension
and pair; ``D = n (n sum y^2 - (sum y)^2)`` undoes the rest of the shift exactly. Totals are combined by Spark as decimals:
the driver gets d (d + 1) / 2 numbers for d dimensions, whatever the number of vectors. Where 64 bits could not hold a block's
squares, the block is summed as Python integers.

Defined results: a vector that is null, or holds a null or a non-finite entry, is dropped. The fit list holds the
vectors of the most frequent length (the longer of equally frequent ones); vectors of another length, empty ones among
them, are not comparable and get no rows. Entries beyond ``MOST`` after scaling count as ``MOST``. A direction without variance has
whitened and explained values 0 and stays out of the identity error. Repeated vectors and ids give repeated rows; a null id stays null.
Columns other than the id and the vector are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
MOST = 1 << 50
BLOCK_ROWS = 512
_LONG = 1 << 63
_DECIMAL = pa.decimal128(38, 0)


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    """floor(1024 c) + 100000 of every entry."""
    scaled = np.floor(vectors.astype(np.float64) * SCALE)
    return np.clip(scaled, -float(MOST), float(MOST)).astype(np.int64) + SHIFT


def usable(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, lengths, flat entries) of the vectors without a null or non-finite entry; entries in row order."""
    entries = column.flatten()  # of lists that are not null
    good = pc.fill_null(pc.is_finite(entries), False).to_numpy(zero_copy_only=False)
    values = pc.fill_null(entries, 0).to_numpy(zero_copy_only=False)
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    bad = np.bincount(owner[~good], minlength=len(lengths)) > 0
    keep = ~bad & column.is_valid().to_numpy(zero_copy_only=False)
    return np.flatnonzero(keep), lengths[keep], values[keep[owner]]


def vectors_of(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, whole numbers as rows x dims) of the usable vectors with ``dims`` entries."""
    rows, lengths, values = usable(column)
    fits = lengths == dims
    return rows[fits], whole_numbers(values[np.repeat(fits, lengths)]).reshape(-1, dims)


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    for batch in batches:
        _, x = vectors_of(batch.column("vector"), dims)
        for at in range(0, len(x), BLOCK_ROWS):
            yield x[at : at + BLOCK_ROWS]


def _rows(totals: np.ndarray, kind: int) -> pa.RecordBatch:
    numbers = pa.array([Decimal(int(v)) for v in totals], _DECIMAL)
    return pa.record_batch(
        [pa.array(np.full(len(totals), kind, np.int32)), pa.array(np.arange(len(totals), dtype=np.int64)), numbers],
        names=["kind", "at", "total"],
    )


_TOTALS = "kind int, at long, total decimal(38,0)"


def _totals(df: DataFrame, task) -> dict[int, dict[int, int]]:
    """Totals of the rows that ``task`` gives: by kind and place."""
    summed = df.mapInArrow(task, _TOTALS).groupBy("kind", "at").agg(F.sum("total").alias("total"))
    out: dict[int, dict[int, int]] = {}
    for kind, at, total in summed.collect():
        out.setdefault(kind, {})[at] = int(total)
    return out


def _length_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths, counts = np.unique(usable(batch.column("vector"))[1], return_counts=True)
        yield pa.record_batch([pa.array(lengths), pa.array(counts)], names=["length", "n"])


def _sum_task(dims: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dims, object)
        for x in _blocks(batches, dims):
            total += x.sum(axis=0).astype(object)
        yield _rows(total, 0)

    return task


def pair_squares(y: np.ndarray) -> np.ndarray:
    """Sums over rows of y_i^2 for every i, then of (y_i + y_j)^2 for every i < j."""
    dims = y.shape[1]
    most = int(np.abs(y).max(initial=0))
    if len(y) * (2 * most) ** 2 >= _LONG:
        y = y.astype(object)
    wide = np.ascontiguousarray(y.T)
    out = [(wide * wide).sum(axis=1)]
    for i in range(dims - 1):
        both = wide[i] + wide[i + 1 :]
        out.append((both * both).sum(axis=1) if y.dtype == object else np.einsum("ij,ij->i", both, both))
    return np.concatenate(out).astype(object)


def _square_task(dims: int, centre: np.ndarray):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = np.zeros(dims, object)
        second = np.zeros(dims * (dims + 1) // 2, object)
        for x in _blocks(batches, dims):
            y = x - centre
            first += y.sum(axis=0).astype(object)
            second += pair_squares(y)
        yield _rows(first, 0)
        yield _rows(second, 1)

    return task


@dataclass(frozen=True)
class Whitening:
    """What the fit knows: enough to whiten any vector of ``dims`` entries."""

    dims: int
    n: int
    sums: list[int]
    centre: np.ndarray
    shift: np.ndarray  # of the mean from the centre
    values: np.ndarray  # eigenvalues, falling
    explained: np.ndarray
    axes: np.ndarray  # dims x components, over the square root of the eigenvalue; 0 without variance

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre).astype(np.float64) - self.shift) @ self.axes

    def deviations(self, x: np.ndarray) -> list[int] | np.ndarray:
        """Exact sums over dimensions of (n x - S)^2."""
        y = x - self.centre
        rest = [s - self.n * int(c) for s, c in zip(self.sums, self.centre)]
        most = self.n * int(np.abs(y).max(initial=0)) + max(map(abs, rest), default=0)
        if self.dims * most**2 < _LONG:
            u = self.n * y - np.array(rest, np.int64)
            return np.einsum("ij,ij->i", u, u)
        u = self.n * y.astype(object) - np.array(rest, object)
        return (u * u).sum(axis=1).tolist()


def covariance(n: int, first: list[int], second: list[int]) -> np.ndarray:
    """Covariances, divisor n, from sums of y_i and of the squares of ``pair_squares``; rounded once."""
    dims = len(first)
    spread = lambda square, total: n * square - total * total  # noqa: E731  n^2 times a variance
    own = [spread(second[i], first[i]) for i in range(dims)]
    out = np.zeros((dims, dims))
    at = dims
    for i in range(dims):
        out[i, i] = own[i] / (n * n)
        for j in range(i + 1, dims):
            out[i, j] = out[j, i] = (spread(second[at], first[i] + first[j]) - own[i] - own[j]) / (2 * n * n)
            at += 1
    return out


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a one-column table ``vector``; None if it holds no usable vector."""
    counts = vectors.mapInArrow(_length_counts, "length long, n long").groupBy("length").agg(F.sum("n").alias("n"))
    best = counts.filter("length > 0").orderBy(F.desc("n"), F.desc("length")).first()
    if best is None:
        return None
    dims, n = best
    sums = [v for _, v in sorted(_totals(vectors, _sum_task(dims))[0].items())]
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    totals = _totals(vectors, _square_task(dims, centre))
    first, second = ([v for _, v in sorted(totals[k].items())] for k in (0, 1))
    values, axes = np.linalg.eigh(covariance(n, first, second))
    values, axes = np.maximum(values[::-1], 0), axes[:, ::-1]
    trace = sum(n * second[i] - first[i] ** 2 for i in range(dims)) / (n * n)
    varies = values > dims * np.finfo(float).eps * values[0]
    scale = np.where(varies, 1 / np.sqrt(np.where(varies, values, 1)), 0)
    explained = np.where(varies, values / (trace or 1), 0.0)
    k = min(components, dims)
    shift = np.array([t / n for t in first])
    return Whitening(dims, n, sums, centre, shift, values[:k], explained[:k], (axes * scale)[:, :k])


def _moment_task(model: Whitening):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = model.axes.shape[1]
        total, square = np.zeros(k), np.zeros((k, k))
        for x in _blocks(batches, model.dims):
            z = model.whitened(x)
            total += z.sum(axis=0)
            square += z.T @ z
        values = np.concatenate([total, square.ravel()])
        yield pa.record_batch([pa.array(np.arange(len(values))), pa.array(values)], names=["at", "value"])

    return task


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened vectors minus the identity, measured on all of them."""
    k = model.axes.shape[1]
    moments = vectors.mapInArrow(_moment_task(model), "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
    flat = np.zeros(k + k * k)
    for at, value in moments.collect():
        flat[at] = value
    mean = flat[:k] / model.n
    error = flat[k:].reshape(k, k) / model.n - np.outer(mean, mean) - np.eye(k)
    live = np.flatnonzero(np.abs(model.axes).any(axis=0))
    return float(np.abs(error[np.ix_(live, live)]).max(initial=0.0))


_OUT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, "
    "deviation_exact decimal(38,0)"
)


def _apply_task(model: Whitening, error: float):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = model.axes.shape[1]
        for batch in batches:
            rows, x = vectors_of(batch.column("vector"), model.dims)
            for at in range(0, len(x), BLOCK_ROWS):
                part = x[at : at + BLOCK_ROWS]
                ids = batch.column("vec_id").take(pa.array(rows[at : at + BLOCK_ROWS]))
                m, each = len(part), pa.array(np.repeat(np.arange(len(part)), k))
                deviations = model.deviations(part)
                if isinstance(deviations, list):
                    short = pa.array([d if d < _LONG else None for d in deviations], pa.int64())
                    exact = pa.array([Decimal(d) if d < 10**38 else None for d in deviations], _DECIMAL)
                else:
                    short = pa.array(deviations)
                    exact = short.cast(pa.decimal128(19, 0)).cast(_DECIMAL)
                yield pa.record_batch(
                    [
                        ids.take(each),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, model.n)),
                        short.take(each),
                        pa.array(model.whitened(part).ravel()),
                        pa.array(np.tile(model.explained, m)),
                        pa.array(np.full(m * k, error)),
                        exact.take(each),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"],
                )

    return task


def whiten(embeddings: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each usable vector and component.

    ``deviation`` is null where the exact sum, in ``deviation_exact`` up to 38 digits, does not fit 64 bits.
    """
    rows = embeddings.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    model = fit_whitening(rows.select("vector"), components)
    if model is None:
        return embeddings.sparkSession.createDataFrame([], _OUT)
    return rows.mapInArrow(_apply_task(model, identity_error(rows.select("vector"), model)), _OUT)
