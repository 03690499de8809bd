"""Every query that has SQL, against the other engine on the smallest tables."""

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, db, name):
    assert compare(entry.queries()[name](spark, SF), db, ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(ORACLE)))
def test_query_without_sql_returns_rows(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "Avg_Sales_Prev_4Wk" in df.columns


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(entry.queries())
