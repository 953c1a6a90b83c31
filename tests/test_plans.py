"""Plan guards: every registered query plans equi-joins only."""

import re

import pytest

import __spark_entry__ as entry_mod
from covspark.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loop_or_cartesian(spark, name):
    plan = entry_mod.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan
    assert "CartesianProduct" not in plan


def test_zonal_scan_prunes_columns_and_pushes_filters(spark):
    plan = entry_mod.queries()["zonal_daily"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    # the events scan reads only the two columns the request key needs
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan
    # cells meet merged windows on slot and tile, never on exploded days
    assert re.search(r"Join \[[^\n]*slot#\d+L?, tx#\d+, ty#\d+\]", plan)
