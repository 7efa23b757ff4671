"""The registered queries against their SQL, over the smallest driver tables."""

import compare
import pytest

from tidelog.llm import queries, sql


@pytest.fixture(scope="module")
def con():
    return compare.connect("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(sql.oracle_sql()))
def test_query(spark, con, sf, name):
    assert compare.difference(queries.queries()[name](spark, sf), con, sql.oracle_sql()[name]) is None


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.queries()) == list(range(1, 14))
