"""Every registered query against its SQL twin."""

from __future__ import annotations

import os

import pytest
from compare import DATA, differences, duck

import __spark_entry__ as contract
from oracle_queries import ORACLES

FOLDER = os.environ.get("QUERY_SF_DIR", f"{DATA}/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.exists(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_every_query_has_a_twin():
    assert set(contract.log_queries()) == set(ORACLES)
    assert contract.log_queries().keys() <= contract.queries().keys()
    assert ORACLES.items() <= contract.oracle_sql().items()


def test_entry(spark):
    found = contract.entry(spark)
    assert found.count() > 0 and "hit_rank" in found.columns


@pytest.mark.parametrize("name", list(contract.log_queries()))
def test_query(spark, connection, name):
    found = contract.queries()[name](spark, FOLDER)
    plan = found._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert unwanted not in plan
    ours, theirs, rows = differences(connection, found, ORACLES[name])
    assert not ours and not theirs, (ours[:3], theirs[:3])
    assert rows > 0 or name == "slowest_endpoints"
