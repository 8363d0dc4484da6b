"""Scale properties of the registered plans (checked on sf0.001)."""

import os

import pytest

from conftest import SF0001

import __spark_entry__ as E

pytestmark = pytest.mark.skipif(not os.path.exists(SF0001), reason="driver data not present")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cross_or_nested_loop_joins(spark):
    bad = {}
    from ledgerloom.plans.queries import QUERIES

    for name, fn in QUERIES.items():
        plan = _plan(fn(spark, SF0001))
        hits = [op for op in ("CartesianProduct", "BroadcastNestedLoopJoin") if op in plan]
        if hits:
            bad[name] = hits
    assert bad == {}


def test_flagship_prunes_columns_and_stays_native(spark):
    plan = _plan(E.entry(spark))
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line or "Scan parquet" in line]
    assert scan and all("o_orderdate" not in line and "o_orderpriority" not in line for line in scan)


def test_flagship_aggregates_before_each_shuffle(spark):
    plan = _plan(E.entry(spark))
    # every hash exchange sits on top of a partial aggregate
    lines = [line.strip(" +-:") for line in plan.splitlines()]
    for i, line in enumerate(lines):
        if line.startswith("Exchange hashpartitioning"):
            assert lines[i + 1].startswith("HashAggregate"), plan
