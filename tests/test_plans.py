"""

No cartesian or nested-loop join, no Python evaluation, and no single-partition
exchange except the ones over already aggregated rows (ntile segment counts,
global aggregates, final ordering of small results).
"""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from paths import SF_SMALL
from ledgerlark.plans.registry import QUERIES

KEYS = sorted(QUERIES)
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas"]


def _plan(spark, key):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the static plan: every exchange visible
    try:
        df = entry.queries()[key](spark, SF_SMALL)
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("key", KEYS)
def test_no_forbidden_operators(spark, key):
    plan = _plan(spark, key)
    for op in FORBIDDEN:
        assert op not in plan, f"{key} plans {op}"


@pytest.mark.parametrize("key", KEYS)
def test_single_partition_only_over_aggregates(spark, key):
    """Every ``Exchange SinglePartition`` must sit directly on a partial aggregate or a window input
    that was itself aggregated (ntile segment counts), never on raw rows."""
    lines = _plan(spark, key).split("\n")
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line and "ReusedExchange" not in line:
            below = "\n".join(lines[i + 1:i + 4])
            assert re.search(r"HashAggregate|ObjectHashAggregate|SortAggregate|TakeOrdered", below), (
                f"{key}: single-partition exchange over rows:\n{below}")


def test_fct_joins_reuse_kpi_partitioning(spark):
    """Four left joins, each KPI side shuffled once by its own aggregate; the spine once."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(spark, "fct_ml_payment_behavior_features")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = re.findall(r"SortMergeJoin \[_app_key[^\]]*\], \[[^\]]*\], LeftOuter", plan)
    assert len(joins) == 4
    spine = re.findall(r"Exchange hashpartitioning\(_app_key", plan)
    assert len(spine) == 1
