"""Every registered query of the package: against its SQL twin, or one row for each document."""

import pytest

from docweave.compare import differences, open_duckdb
from docweave.llm import queries


@pytest.fixture(scope="module")
def connection():
    return open_duckdb("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.TWINS))
def test_query_agrees_with_sql(spark, sf, connection, name):
    assert differences(queries.QUERIES[name](spark, sf), connection, queries.TWINS[name]) == ""


OTHER_TABLES = {"op11_embedding_whitening", "op13_conversation_repair"}


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.TWINS) - OTHER_TABLES))
def test_query_returns_every_document(spark, sf, name):
    ids = [r["doc_id"] for r in queries.QUERIES[name](spark, sf).select("doc_id").collect()]
    expected = [r["doc_id"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()]
    assert sorted(ids) == sorted(expected)
