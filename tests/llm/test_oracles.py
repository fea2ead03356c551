"""Queries against their SQL."""

import pytest

from sportmart.llm.queries import ORACLE, QUERIES
from tests.oracle import bag, connect, run_sql, types_of

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sql, name):
    df = QUERIES[name](spark, SF_DIR)
    rows = [tuple(row) for row in df.collect()]
    columns, expected = run_sql(sql, ORACLE[name])
    assert sorted(df.columns) == sorted(columns)
    assert types_of(df.columns, rows) == types_of(columns, expected)
    assert bag(df.columns, rows) == bag(columns, expected)


def test_numbered_queries():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, len(QUERIES) + 1))
