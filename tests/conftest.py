import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from docweave.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("docweave-tests", "local[4]", 4)
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """``frame(rows, schema)`` as a DataFrame."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def one(spark):
    """Value of a column expression over one row of literals."""

    def evaluate(expression, **values):
        from pyspark.sql import functions as F

        row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1).alias("_")])
        return row.select(expression.alias("r")).first()["r"]

    return evaluate


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
