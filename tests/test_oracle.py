"""Every registered query against its SQL on the smallest tables."""

import pytest

from suite import all_oracles, all_queries

from oracle import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    if name in ORACLES:
        assert compare(spark, con, name, QUERIES[name], ORACLES[name], SF) == []
    else:
        assert QUERIES[name](spark, SF).count() > 0
