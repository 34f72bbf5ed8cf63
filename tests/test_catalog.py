"""Every registered query against its SQL twin, on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point

FOLDER = os.environ.get("QUILLRUN_TEST_TABLES", entry_point.SMOKE_FOLDER)
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES, TWINS = entry_point.queries(), entry_point.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value


def as_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_query_equals_its_twin(spark, duck, name):
    got = QUERIES[name](spark, FOLDER)
    want = duck.sql(TWINS[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert as_rows(got.columns, got.collect()) == as_rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(TWINS)))
def test_query_without_twin_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_every_twin_has_a_query():
    assert set(TWINS) <= set(QUERIES)


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["query_id", "rank", "doc_id", "score"]
