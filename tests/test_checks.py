"""Data checks: each with a passing and a violating input."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.operators import checks as ck


def _f(df):
    return {(r.model, r.column_name): r.failures for r in df.collect()}


def test_unique(spark):
    ok = spark.createDataFrame([(1,), (2,), (None,), (None,)], "k long")
    bad = spark.createDataFrame([(1,), (1,), (2,), (2,), (2,), (3,)], "k long")
    assert _f(ck.check_unique(ok, "k", "t")) == {("t", "k"): 0}
    assert _f(ck.check_unique(bad, "k", "t")) == {("t", "k"): 2}


def test_not_null(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, 1)], "a long, b long")
    assert _f(ck.check_not_null(df, ["a", "b"], "t")) == {("t", "a"): 1, ("t", "b"): 2}


def test_accepted_values(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (2,), (7,), (None,)], "v long")
    assert _f(ck.check_accepted_values(df, "v", [0, 1], "t")) == {("t", "v"): 2}
    assert _f(ck.check_accepted_values(df, "v", [0, 1, 2, 7], "t")) == {("t", "v"): 0}


def test_accepted_values_with_filter(spark):
    df = spark.createDataFrame([("C",), ("X",), ("3",), ("9",)], "s string")
    d = F.col("s").try_cast("bigint")
    out = ck.check_accepted_values(df, d, list(range(6)), "t", name="dpd", where=d.isNotNull())
    assert _f(out) == {("t", "dpd"): 1}


def test_accepted_range(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (5.0,), (None,)], "x double")
    assert _f(ck.check_accepted_range(df, "x", "t", min_value=0)) == {("t", "x"): 1}
    assert _f(ck.check_accepted_range(df, "x", "t", min_value=-1, max_value=5)) == {("t", "x"): 0}


def test_join_preserves_rows(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    good = spark.createDataFrame([(1, 10), (2, None), (3, 5)], "k long, v long")
    fanned = spark.createDataFrame([(1, 10), (1, 11), (2, None), (3, 5)], "k long, v long")
    hit = F.col("v").isNotNull().alias("has_monthly_history")
    assert _f(ck.check_join_preserves_rows(left, good.select("*", hit), "k", "m")) == {("m", "k"): 0}
    assert _f(ck.check_join_preserves_rows(left, fanned.select("*", hit), "k", "m")) == {("m", "k"): 2}
