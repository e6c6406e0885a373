"""Every registered query gives the rows of its SQL, on the smallest test data."""

import os

import pytest

import __spark_entry__ as entry_points
from compare import difference, oracle_connection
from helpers import plan_of
from siltstone.workload.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys() <= entry_points.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, name):
    assert difference(spark, connection, name, SF_DIR) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n != "stream_upsert"])
def test_plan_scales(spark, settings, name):
    """No Python per row, no cross join, nothing that needs a side to be small."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    )
    plan = plan_of(entry_points.queries()[name](spark, SF_DIR))
    for node in ("Python", "Pandas", "NestedLoop", "CartesianProduct"):
        assert node not in plan
    if name == "incremental_fold":  # one row per delta, for the rows and their keys
        assert plan.count("BroadcastHashJoin") <= 3
    else:
        assert "BroadcastHashJoin" not in plan


def test_entry(spark):
    assert len(entry_points.entry(spark).columns) == 52
