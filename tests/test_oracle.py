"""Every catalogue query against its SQL."""

import pytest

from sportmart.plans.catalogue import QUERIES
from tests.oracle import bag, connect, run_sql, types_of

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, sql, name):
    query = QUERIES[name]
    df = query(spark, SF_DIR)
    rows = [tuple(row) for row in df.collect()]
    columns, expected = run_sql(sql, query.sql)
    assert sorted(df.columns) == sorted(columns)
    assert types_of(df.columns, rows) == types_of(columns, expected)
    assert bag(df.columns, rows) == bag(columns, expected)


def test_every_query_names_the_items_it_covers():
    assert all(query.operators and query.sql for query in QUERIES.values())
