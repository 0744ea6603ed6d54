import math
from fractions import Fraction

import numpy as np
import pytest

from docweave.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def by_hand(vectors, components=8):
    """Definition with exact fractions: (n, S, V, eigenvalues, eigenvectors)."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(col) for col in zip(*x)]
    u = [[n * a - s for a, s in zip(row, sums)] for row in x]
    cov = [[float(Fraction(sum(r[i] * r[j] for r in u), n**3)) for j in range(d)] for i in range(d)]
    values, axes = np.linalg.eigh(np.array(cov))
    return x, n, sums, u, np.array(cov), values[::-1], axes[:, ::-1]


def test_query_agrees_with_definition(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    vectors = [r["embedding"] for r in table]
    x, n, sums, u, cov, values, axes = by_hand(vectors)
    got = queries.QUERIES["op11_embedding_whitening"](spark, sf).collect()
    assert len(got) == 8 * len(table)
    rows = {(r["vec_id"], r["component"]): r for r in got}
    assert len(rows) == len(got)
    expected = (np.array(x, float) - np.array(sums) / n) @ axes[:, :8] / np.sqrt(values[:8])
    found = np.array([[rows[r["vec_id"], k]["whitened"] for k in range(1, 9)] for r in table])
    signs = np.sign((expected * found).sum(axis=0))
    assert np.abs(found * signs - expected).max() < 1e-8
    for r, deviations in zip(table, u):
        row = rows[r["vec_id"], 1]
        assert row["deviation"] == sum(a * a for a in deviations) == int(row["deviation_exact"])
        assert row["n"] == n
    for k in range(8):
        assert rows[table[0]["vec_id"], k + 1]["explained"] == pytest.approx(values[k] / np.trace(cov), rel=1e-9)
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]}
    assert got[0]["identity_error"] < 1e-9


def test_polarised_covariance_is_exact():
    rng = np.random.default_rng(3)
    for scale in (5, 1 << 20, 1 << 44):
        y = rng.integers(-scale, scale, (40, 6))
        squares = whitening.pair_squares(y)
        got = whitening.covariance(40, [int(v) for v in y.astype(object).sum(axis=0)], list(squares))
        z = y.astype(object) * 40 - y.astype(object).sum(axis=0)
        expected = [[float(Fraction(int((z[:, i] * z[:, j]).sum()), 40**3)) for j in range(6)] for i in range(6)]
        assert np.array_equal(got, np.array(expected))


def test_unusable_vectors_are_left_out(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], 0), (2, None, 0), (3, [1.0, None], 0), (4, [nan, 1.0], 0), (5, [inf, 1.0], 0), (6, [-inf, 1.0], 1)]
    rows += [(7, [0.5, -2.0], 0), (None, [3.0, 1.0], 0), (7, [0.5, -2.0], 0), (8, [], 0), (9, [1.0], 0)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in got) == [(0, 1), (0, 2), (1, 1), (1, 2), (7, 1), (7, 1), (7, 2), (7, 2)]
    assert {r["n"] for r in got} == {4}
    z = np.array([r["whitened"] for r in got if r["component"] == 1])
    assert (z**2).mean() == pytest.approx(1)


def test_equal_vectors_one_vector_and_none(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0, 3.0], 0) for i in range(5)], SCHEMA)
    got = whitening.whiten(same).collect()
    assert len(got) == 15 and {(r["whitened"], r["explained"], r["deviation"], r["identity_error"]) for r in got} == {(0.0, 0.0, 0, 0.0)}
    assert whitening.whiten(same.limit(0)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None, 0)], SCHEMA)).count() == 0


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(2.0**39) * (i % 3), float(i), -1e30 if i == 1 else 0.0], 0) for i in range(6)]
    got = {(r["vec_id"], r["component"]): r for r in whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()}
    x = [[min(max(math.floor(1024 * float(np.float32(c))), -whitening.MOST), whitening.MOST) + 100_000 for c in r[1]] for r in rows]
    sums = [sum(c) for c in zip(*x)]
    for i, row in enumerate(x):
        exact = sum((6 * a - s) ** 2 for a, s in zip(row, sums))
        assert int(got[i, 1]["deviation_exact"]) == exact
        assert got[i, 1]["deviation"] == (exact if exact < 1 << 63 else None)


def test_clashing_columns(spark):
    schema = "vec_id long, embedding array<float>, vector string, n string, component string"
    got = whitening.whiten(spark.createDataFrame([(1, [1.0, 0.0], "a", "b", "c"), (2, [0.0, 3.0], "a", "b", "c")], schema))
    assert got.count() == 4
