"""Every query gives in Spark what its SQL gives, and none has a plan that cannot grow."""

import re

import pytest

import __spark_entry__ as entry_point
from oracle import connect, differences
from tidemark.catalog import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, tables, name):
    assert differences(spark, name, FOLDER, QUERIES, SQL, tables) is None


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["site", "time", "daily_mean", "daily_core"] and df.count() > 0
    assert entry_point.queries().keys() >= QUERIES.keys() and entry_point.oracle_sql().keys() >= SQL.keys()


# Reading from what a query itself wrote or checkpointed hides the plan that made it; those are looked at in their parts.
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_can_grow(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "ArrowEval" not in plan
    assert "SinglePartition" not in plan


@pytest.mark.parametrize(
    "name", ["qc_spike", "rolling_center", "infill_linear", "infill_alt_dynamic", "mad_despike", "snow_estimated_counts"]
)
def test_series_are_windowed_in_chunks(spark, name):
    """A window over the rows of a whole series would put it in one task. Only windows over one row per chunk may."""
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    windows = re.findall(r"Window \[.*?\], \[(.*?)\]", plan)
    assert windows and any("_chunk" in keys for keys in windows)
    for keys in windows:
        if "_chunk" not in keys:
            assert "site" in keys
    whole_series = [line for line in plan.splitlines() if "Window [" in line and "_chunk" not in line]
    # Such a window reads edges, counts or carries, never the values themselves.
    assert all(re.search(r"_first_|_last_|_in_chunk|_tail|_restarts|_reached|_run", line) for line in whole_series)
