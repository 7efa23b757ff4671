"""Every registered query against its SQL, over the smallest driver tables."""

import compare
import pytest

import __spark_entry__ as entry_points

QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()
SAMPLES = sorted(entry_points._sql.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return compare.connect("/root/testdata/sf0.001")


def test_every_query_has_sql():
    assert sorted(entry_points._queries.queries()) == SAMPLES
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", SAMPLES)
def test_query(spark, con, sf, name):
    assert compare.difference(QUERIES[name](spark, sf), con, SQL[name]) is None


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
