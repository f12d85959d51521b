"""The queries that SQL can express, against it on another engine, over whole tables."""

import pytest

from starloom.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import differences, duckdb_over


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(name, spark, sf_dir):
    assert differences(QUERIES[name](spark, sf_dir), duckdb_over(sf_dir), ORACLE_SQL[name]) == []


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
