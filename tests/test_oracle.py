"""Every registered query against its SQL twin."""

import pytest
from check_oracle import compare, connect
from conftest import SF_DIR

from recordflow.catalog import all_queries, all_sql

QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    assert frame.columns, name
    if name in SQL:
        assert compare(duck, frame, SQL[name]) == ""
    else:
        frame.count()


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.queries()) >= set(QUERIES) and set(entry.oracle_sql()) >= set(SQL)
