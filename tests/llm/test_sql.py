"""The queries that SQL can express, against it."""

import check_queries
import pytest

from quirework.llm.queries import QUERIES


@pytest.fixture(scope="module")
def database(small):
    return check_queries.database(small)


@pytest.mark.parametrize("name", [name for name, (_, sql) in QUERIES.items() if sql])
def test_query_equals_sql(spark, small, database, name):
    run, sql = QUERIES[name]
    assert check_queries.compare(spark, database, run, sql, small) is None


def test_null_sources_are_a_source(spark, tmp_path):
    """The mix and its SQL, where a source and a text are null."""
    rows = [(i, None if i % 7 == 0 else "w " * (i % 9), None if i % 3 == 0 else f"s{i % 2}") for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    run, sql = QUERIES["op10_capped_mix"]
    assert check_queries.compare(spark, con, run, sql, str(tmp_path)) is None
