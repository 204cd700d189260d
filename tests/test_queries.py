"""Every report against its SQL twin, and what its plan must not contain."""

import pytest

from shopledger.plans.oracle import ORACLE_SQL
from shopledger.plans.queries import QUERIES
from tools.check_oracle import compare, connect


@pytest.fixture(scope="module")
def duck(data):
    return connect(data)


def test_every_query_has_a_twin():
    assert set(ORACLE_SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, data, duck, name):
    assert compare(spark, duck, data, name) == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_is_distributed(spark, data, name):
    plan = QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "MapInPandas", "InPandas"):
        assert word not in plan, word
