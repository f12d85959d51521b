"""Every registered query against its SQL on another engine, over whole tables."""

import pytest

import __spark_entry__ as contract
from starloom.catalog import QUERIES
from tests.compare import differences, duckdb_over


@pytest.fixture(scope="module")
def con(sf_dir):
    return duckdb_over(sf_dir)


def test_every_query_has_sql():
    """Of the library's own; those for training data are tested with their package."""
    assert set(QUERIES) <= set(contract.queries()) and set(QUERIES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(name, spark, sf_dir, con):
    df = contract.queries()[name](spark, sf_dir)
    assert differences(df, con, contract.oracle_sql()[name]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_entry_is_ordered_by_revenue(spark):
    rows = contract.entry(spark).collect()
    assert rows and [r["revenue"] for r in rows] == sorted((r["revenue"] for r in rows), reverse=True)


def test_result_types_are_those_declared(spark, sf_dir):
    kinds = dict(contract.queries()["dim_customer"](spark, sf_dir).dtypes)
    assert kinds["Customer_Key"] == "bigint" and kinds["Valid_From"] == "date"
