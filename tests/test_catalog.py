"""Every registered query against its SQL, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from corpusmill.plans.catalog import QUERIES
from corpusmill.plans.catalog_sql import SQL

SF = "/root/testdata/sf0.001"
TABLES = "documents pages embeddings conversations benchmark labels".split()
WITHOUT_SQL = {"compression_compare", "staged_build_report"}


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    found = [tuple(plain(r[i]) for i in order) for r in records]
    return sorted(columns), sorted(found, key=repr)


def test_registration():
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL
    assert set(SQL) <= set(QUERIES)
    assert QUERIES.items() <= entry.queries().items() and SQL.items() <= entry.oracle_sql().items()


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["page_id", "text", "n_bytes"] and result.count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, database, name):
    result = entry.queries()[name](spark, SF)
    got = rows(result.columns, [tuple(r) for r in result.collect()])
    answer = database.execute(entry.oracle_sql()[name])
    assert got == rows([d[0] for d in answer.description], answer.fetchall())


def test_compression_shares(spark):
    got = {r.grp: r for r in entry.queries()["compression_compare"](spark, SF).collect()}
    parts = [r for g, r in got.items() if g != "ALL"]
    assert got["ALL"].raw_bytes == sum(r.raw_bytes for r in parts)
    assert got["ALL"].stored_bytes <= sum(r.stored_bytes for r in parts)
    assert all(0 < r.gz_share < 1 and 0 < r.stored_share <= 1 for r in got.values())


def test_the_fixtures_show_both_sides(spark):
    """Batches without targets, a gate that opens, and damaged input occur in the queries."""
    everything = entry.queries()
    mean = everything["sparse_batch_mean"](spark, SF).first()
    assert 0 < mean.used < mean.batches == math.ceil(spark.read.parquet(f"{SF}/documents.parquet").count() / 8)
    assert everything["valid_sparse_batches"](spark, SF).count() == mean.used
    assert everything["size_gate_open"](spark, SF).first().reuse and not everything["size_gate"](spark, SF).first().reuse
    assert everything["tolerant_lines"](spark, SF).where("cause IS NOT NULL").count() == 2
    assert everything["rejected_pages"](spark, SF).count() == 2
    linked = everything["line_overlap"](spark, SF).where("jaccard IS NOT NULL").count()
    assert linked > 0
