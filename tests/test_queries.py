"""Every registered query against its SQL."""

import pytest
from compare import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, sf_dir, connection, name):
    assert compare(QUERIES[name](spark, sf_dir), SQL[name], connection) is None


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() == 1
