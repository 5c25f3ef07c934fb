"""Every query against its SQL on the smallest tables."""

import check_queries
import pytest

import __spark_entry__ as entry_module
from quirework.queries import all_queries

QUERIES = all_queries()


@pytest.fixture(scope="module")
def database(small):
    return check_queries.database(small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, small, database, name):
    run, sql = QUERIES[name]
    assert check_queries.compare(spark, database, run, sql, small) is None


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
