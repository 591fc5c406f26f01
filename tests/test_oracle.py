"""Every registered query against its DuckDB SQL."""

import duckdb
import pytest

import __spark_entry__ as contract
from compare import differences, duck
from conftest import SMALL

from logassay.plans.catalog import QUERIES
from logassay.plans.oracle import oracle

SQL = oracle()
# Without SQL: file sizes, and a quantile that may differ by the stated rank error.
ROWS_ONLY = {"storage_footprint", "approximate_quantiles"}


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_sql_or_a_reason():
    assert set(QUERIES) - set(SQL) == ROWS_ONLY
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SMALL), con, SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_runs(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_comparison_sees_a_difference(spark):
    con = duckdb.connect()
    one = spark.sql("SELECT bigint(1) AS a, 'x' AS b")
    assert differences(one, con, "SELECT CAST(1 AS BIGINT) AS a, 'x' AS b") == ""
    assert differences(one, con, "SELECT CAST(2 AS BIGINT) AS a, 'x' AS b") != ""
    assert differences(one, con, "SELECT CAST(1 AS INTEGER) AS a, 'x' AS b") != ""
    assert differences(one, con, "SELECT CAST(1 AS BIGINT) AS a, 'x' AS c") != ""


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
