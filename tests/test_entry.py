"""The driver's contract, with or without the training-data subpackage."""

import __spark_entry__
from suite import all_oracles, all_queries


def test_every_query_and_its_sql_are_listed():
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(all_queries()) <= set(queries) and set(all_oracles()) <= set(sql) <= set(queries)
    assert all(callable(q) for q in queries.values())
