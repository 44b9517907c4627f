"""Every query with SQL is held against it; the others have to run with a stable schema."""

import pytest
from oracle import compare, database

from seedloom.plans import catalogue_queries, pipeline_queries, pipeline_sql, surface_queries

QUERIES = {**catalogue_queries.QUERIES, **surface_queries.QUERIES, **pipeline_queries.QUERIES}
SQL = {**catalogue_queries.SQL, **surface_queries.SQL, **pipeline_sql.SQL}


@pytest.fixture(scope="module")
def con(data):
    return database(data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, con, name):
    if name in SQL:
        compare(spark, data, QUERIES[name], SQL[name], con)
    else:
        df = QUERIES[name](spark, data)
        assert df.columns == QUERIES[name](spark, data).columns
        assert df.count() >= 0


def test_sql_names_are_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry_imports_without_the_text_subpackage(spark, data):
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["code", "recordId", "message"]
