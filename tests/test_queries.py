"""Every registered query on the smallest fixtures, against its SQL where there is one."""

import pytest
from conftest import SMALL
from oracle import connect, difference

import __spark_entry__ as entry_points


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(entry_points.queries()))
def test_query(spark, con, name):
    df = entry_points.queries()[name](spark, SMALL)
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert difference(con, sql, df) is None


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() == 31


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
