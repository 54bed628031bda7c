"""Every registered query against the same query in another engine."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from checks.compare import connect, differences
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_equals_sql(spark, duck, name):
    df = entry_point.queries()[name](spark, SF_DIR)
    assert differences(df, duck, entry_point.oracle_sql()[name]) == []


def test_entry_has_rows_and_the_mart_columns(spark):
    df = entry_point.entry(spark)
    assert len(df.columns) == 72
    assert df.count() == 6000
