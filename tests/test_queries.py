"""Every registered query against its DuckDB statement."""

import pytest

import __spark_entry__ as registry
from eventlake.plans import catalog, oracle
from tests.compare import duck, duck_rows, spark_rows

SMALL = "/root/testdata/sf0.001"
SQL = oracle.all_sql()
# No query pairs all rows of two frames or hands rows to Python.
NEVER = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_a_statement():
    assert set(catalog.all_queries()) == set(SQL)
    assert set(SQL) <= set(registry.queries()) and set(SQL) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_statement(spark, con, name):
    df = registry.queries()[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [operator for operator in NEVER if operator in plan]
    assert spark_rows(df) == duck_rows(con, SQL[name])


def test_entry(spark):
    df = registry.entry(spark)
    assert df.columns == ["user_id", "service", "usage_type", "events", "total_quantity"]
    assert df.count() > 0
