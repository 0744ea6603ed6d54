import random

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def docs(spark):
    """``docs([(doc_id, text), ...])`` or with source as a third value."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture
def noise():
    """``noise(n, seed)``: n invented words."""

    def make(n, seed=0):
        rng = random.Random(seed)
        return [f"{rng.choice('bcdfgh')}{rng.choice('aeiou')}{rng.randrange(10_000)}x" for _ in range(n)]

    return make


EDGE_TEXTS = [None, "", " ", "\n\n", "a", " ", "one two \u0001 three", "x" * 50_000, "word " * 30_000]
