"""Every query against its SQL twin."""

import pytest

import __spark_entry__ as entry
from docweave.compare import differences, open_duckdb

SF = "/root/testdata/sf0.001"
QUERIES, TWINS = entry.registry.QUERIES, entry.registry.TWINS


@pytest.fixture(scope="module")
def connection():
    return open_duckdb(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, connection, name):
    result = QUERIES[name](spark, SF)
    assert name in TWINS
    assert differences(result, connection, TWINS[name]) == ""


def test_flagship_entry(spark):
    document = entry.entry(spark)
    assert {"id", "tags", "actor", "version_id"} <= set(document.columns)
    assert document.count() > 0
