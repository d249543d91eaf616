"""Every registered query against its SQL on the test tables, values and types."""

import pytest

import __spark_entry__ as entry_points
from compare import connect, differences, type_differences

from rondel.plans.catalog import QUERIES, SQL


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, sf_dir, con, name):
    result = QUERIES[name](spark, sf_dir)
    assert differences(result, con, SQL[name]) == []
    assert type_differences(result, con, SQL[name]) == {}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_only(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries()) >= set(QUERIES)


def test_entry(spark):
    result = entry_points.entry(spark)
    assert "win_rate" in result.columns and result.count() > 0
