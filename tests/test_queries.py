"""Every registered query against its SQL, on the smallest driver tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, con, name):
    df = contract.queries()[name](spark, SF)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, sql, con) == []


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) > 0 and set(rows[0].asDict()) == {"brand", "orders", "revenue", "margin"}


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
