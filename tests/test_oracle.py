"""Every query that has SQL equals it."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import compare, duck

SF = "/root/testdata/sf0.01"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, con, name):
    df = queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "EvalPython" not in plan
    if name in SQL:
        assert compare(df, con, SQL[name]) == ""
    else:
        assert df.count() > 0


def test_sql_belongs_to_a_query():
    assert set(SQL) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["jaar", "percentage_metingen"]
