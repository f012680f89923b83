"""Every query with an SQL counterpart, compared in DuckDB on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from check import connect, difference

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name, capsys):
    df = QUERIES[name](spark, SF)
    df.explain()
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert difference(df, duck.execute(ORACLES[name]).df()).startswith("ok")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, SF).limit(5).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 5
