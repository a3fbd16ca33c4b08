"""Every query of the workload next to its SQL, on the smallest of the given data sets."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences
from workload import registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the given tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert registry.QUERIES.keys() == registry.ORACLES.keys()
    assert registry.QUERIES.keys() <= entry.queries().keys()


def test_entry(spark):
    assert sorted(entry.entry(spark).columns) == ["category", "d", "gmv", "n"]


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    assert differences(registry.QUERIES[name](spark, SF_DIR), con, registry.ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_pairs_of_everything(spark, name):
    plan = registry.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
