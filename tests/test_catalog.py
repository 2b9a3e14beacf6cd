"""Every registered query gives the rows its SQL gives."""

import pytest
from oracle import compare, tables

import __spark_entry__ as entry_points
from weir.catalog import load_all

QUERIES = load_all()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return tables(sf_dir)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_rows_equal_sql(spark, connection, sf_dir, name):
    assert compare(spark, connection, QUERIES[name], sf_dir) > 0


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["agg_ts", "pk", "sk", "value"]


def test_entry_points_cover_the_catalog():
    assert set(entry_points.queries()) >= set(QUERIES)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
