"""The join of lineitem and orders is dealt to tasks by bytes, not only by what AQE coalesces."""

from __future__ import annotations

import datetime
from collections import Counter

import pytest

import __spark_entry__ as entry
from ledgerlark.sources import fixtures

ORDERS, LINES = 400, 4


@pytest.fixture
def tables(spark, tmp_path):
    """Every order has ``LINES`` lines, a tenth of the lines twice; some orders lack a customer, some lines an order."""
    day = datetime.datetime(1996, 1, 2)
    orders = [(k, None if k % 50 == 7 else k % 37, "O", 10.0 * k, day, "5-LOW") for k in range(ORDERS)]
    lines = [(k + 3, k * 7 + n, k % 20, n, 1.0, 100.0 + k + n) for k in range(ORDERS) for n in range(LINES)]
    lines += lines[::10] + [(None, 1, 1, 1, 1.0, 5.0)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                          "o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                          "l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("key", ["int_installments_customer_features", "int_installments_features"])
def test_large_join_is_dealt_by_bytes(spark, tables, monkeypatch, key):
    def rows():
        monkeypatch.setattr(fixtures, "_CACHE", {})
        return Counter(tuple(r) for r in entry.queries()[key](spark, tables).collect())

    small = rows()  # by its bytes one task's worth: left to Spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        monkeypatch.setattr(fixtures, "TASK_BYTES", 256, raising=False)
        assert rows() == small and len(small) >= 30
        found = fixtures.fixture_tables(spark, tables)
        dealt = getattr(found, "by_loan", found)["installments_payments"]
        assert dealt.count() == sum(LINES for k in range(3, ORDERS)) + len([k for k in range(0, ORDERS * LINES, 10) if k // LINES + 3 < ORDERS])
        assert dealt.rdd.getNumPartitions() >= 32  # AQE alone makes one task of these rows
        plain = found["installments_payments"]  # where an exchange follows, Spark may split a skewed order
        assert "REPARTITION" not in plain._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_join_is_left_to_spark(spark, tables, monkeypatch):
    """Below ``LEAST_TASKS`` the plan has no exchange of its own, so the smaller side can be broadcast."""
    monkeypatch.setattr(fixtures, "_CACHE", {})
    assert fixtures.join_tasks(spark, tables) == 0
    plan = fixtures.fixture_tables(spark, tables).by_loan["installments_payments"]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "REPARTITION" not in plan
