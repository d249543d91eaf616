"""Corpus queries that SQL can express, against it, values and types."""

import pytest

from compare import connect, differences, type_differences
from rondel.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, sf_dir, name):
    con = connect(sf_dir)
    result = QUERIES[name](spark, sf_dir)
    assert differences(result, con, SQL[name]) == []
    assert type_differences(result, con, SQL[name]) == {}
