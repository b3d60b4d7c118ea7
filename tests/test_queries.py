"""Every registered query against its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from catloom.plans import all_oracles, all_queries
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, SF, QUERIES[name], ORACLES[name]) == ""


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
