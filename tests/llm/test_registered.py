"""The operators' queries: which are registered, and their rows against their SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from corpusmill.llm.queries import QUERIES
from corpusmill.llm.queries_sql import SQL
from tests.test_catalog import SF, TABLES, rows

# Trained models, tokenizers, samples and compressors have no SQL, and all runs of a long text are too slow there.
WITHOUT_SQL = {
    "op2_packing", "op3_toxicity", "op5_language_id", "op6_license_scans", "op7_piece_sampling", "op8_pii",
    "op13_periodic_runs",
}


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_registration():
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL and set(SQL) <= set(QUERIES)
    assert QUERIES.items() <= entry.queries().items() and SQL.items() <= entry.oracle_sql().items()
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, database, name):
    result = entry.queries()[name](spark, SF)
    got = rows(result.columns, [tuple(r) for r in result.collect()])
    answer = database.execute(entry.oracle_sql()[name])
    assert got == rows([d[0] for d in answer.description], answer.fetchall())
