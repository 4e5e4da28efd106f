"""Every registered query against its SQL, and rules every plan must keep."""

import pytest
from compare import compare

import __spark_entry__ as contract

# The optional subpackage's queries have their own tests.
QUERIES = contract.registry.registered()
ORACLES = contract.oracles.statements()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf, duckdb_con):
    df = QUERIES[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert node not in plan
    if name in ORACLES:
        assert compare(df, duckdb_con, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_contract_has_every_query():
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
