"""Every query against its oracle on the smallest tables."""

import os

import pytest

from tests.check_oracle import compare, oracle
from workload import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    return oracle(SF_DIR)


def no_slow_plan(df):
    """No Python in any plan, no cross join."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    assert compare(spark, db, SF_DIR, name, no_slow_plan) is None


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
