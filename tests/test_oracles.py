"""Every query with SQL gives the same names, types and values as DuckDB."""

import pytest
from compare import differences, duck

import __spark_entry__ as entry_points

QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, con, small, name):
    assert differences(QUERIES[name](spark, small).toArrow(), con.sql(ORACLES[name]).to_arrow_table()) == []


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    amounts = [r["aggregate_matched_amount"] for r in rows]
    assert len(rows) == 84 and amounts == sorted(amounts, reverse=True)


def test_names():
    assert set(ORACLES) <= set(QUERIES)
