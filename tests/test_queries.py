"""Every query against its SQL on the smallest tables; the others must run and give rows."""

import pytest
from comparison import connect, difference
from conftest import SMALL

import __spark_entry__ as contract
from basketry.plans import catalog, oracle

QUERIES, SQL = catalog.QUERIES, oracle.statements()
WITHOUT_SQL = sorted(set(QUERIES) - set(SQL))


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_entry(spark):
    df = contract.entry(spark)
    assert {"CustomerKey", "RFM_score", "Segment"} <= set(df.columns)
    assert df.count() > 100


def test_names_agree():
    assert set(SQL) <= set(QUERIES) <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SMALL), duck, SQL[name]) is None


@pytest.mark.parametrize("name", WITHOUT_SQL)
def test_runs(spark, name):
    rows = QUERIES[name](spark, SMALL).collect()
    assert rows
