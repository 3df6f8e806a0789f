"""Distributed ntile equals Spark's own single-partition ntile, row for row."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlark.operators import ranks
from ledgerlark.operators.ntile import distributed_ntile
from ledgerlark.operators.ranks import quantile_rank, values_at_ranks


def _reference(df, n):
    w = Window.orderBy(F.col("x").asc_nulls_first(), F.col("id"))
    return {r.id: r.b for r in df.withColumn("b", F.ntile(n).over(w)).collect()}


def _ours(df, n):
    return {r.id: r.b for r in distributed_ntile(df, "x", "id", n, "b").collect()}


@pytest.mark.parametrize("n_rows,n", [(1500, 10), (1493, 10), (7, 10), (1, 3), (100, 4)])
def test_matches_window_ntile(spark, n_rows, n):
    rnd = random.Random(n_rows)
    rows = [(i, None if rnd.random() < 0.1 else float(rnd.randint(0, 50))) for i in range(n_rows)]
    df = spark.createDataFrame(rows, "id long, x double")
    assert _ours(df, n) == _reference(df, n)


def test_hot_value_and_hot_nulls_are_split(spark):
    # one value holds a third of the rows, NULLs another third
    rows = [(i, 7.0 if i % 3 == 0 else (None if i % 3 == 1 else float(i % 97))) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, x double")
    assert _ours(df, 10) == _reference(df, 10)


def test_integers_and_close_doubles(spark):
    rows = [(i, 10**15 + i % 7) for i in range(500)] + [(1000 + i, -(10**15)) for i in range(50)]
    assert _ours(df := spark.createDataFrame(rows, "id long, x long"), 9) == _reference(df, 9)
    rows = [(i, 1e9 + i * 1e-7) for i in range(400)] + [(1000, -1e300), (1001, 1e300)]
    assert _ours(df := spark.createDataFrame(rows, "id long, x double"), 7) == _reference(df, 7)
    rows = [(i, v) for i, v in enumerate([float("nan"), 1.0, float("-inf"), None, 1.7e308, -1.7e308, float("inf"), float("nan"), None, 0.0])]
    for n in (2, 3, 10):  # NaN is last, infinities and the widest range order as numbers do
        assert _ours(df := spark.createDataFrame(rows, "id long, x double"), n) == _reference(df, n)


@pytest.mark.parametrize("p", [0.01, 0.25, 0.5, 0.75, 0.99])
def test_quantiles_per_group(spark, p):
    rnd = random.Random(8)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([None, 0.0, rnd.random() * 1e6, -5.5])) for _ in range(700)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = values_at_ranks(df, "v", lambda _, n: [quantile_rank(n, p)], group="g")
    for g in ("a", "b", None):
        own = sorted(v for h, v in rows if h == g and v is not None)
        k = quantile_rank(len(own), p)
        value = own[k - 1]
        assert got[g] == {k: (value, sum(v < value for v in own))}


@pytest.mark.parametrize("limit,literals", [(200_000, 128), (50, 128), (50, 0)])
def test_brackets_written_by_range(spark, monkeypatch, limit, literals):
    """Large brackets go by way of a table sorted by range; the ranks are the same, ties and NULLs included."""
    rnd = random.Random(4)
    monkeypatch.setattr(ranks, "MAX_LITERALS", literals)
    monkeypatch.setattr(ranks, "MAX_COLLECTED", limit)
    rows = [(i, rnd.choice([None, 3.0, 3.0, rnd.random() * 100, float(rnd.randrange(20))]), rnd.choice("ab")) for i in range(6000)]
    df = spark.createDataFrame(rows, "id long, x double, g string").repartition(7)
    assert _ours(df, 10) == _reference(df, 10)
    got = values_at_ranks(df, "x", lambda _, n: [quantile_rank(n, p) for p in (0.01, 0.5, 0.99)], group="g")
    for g in "ab":
        own = sorted(v for _, v, h in rows if h == g and v is not None)
        ks = [quantile_rank(len(own), p) for p in (0.01, 0.5, 0.99)]
        assert got[g] == {k: (own[k - 1], sum(v < own[k - 1] for v in own)) for k in ks}


def test_bracket_without_its_rank_is_widened(spark, monkeypatch):
    df = spark.range(5000).select(F.col("id"), F.col("id").cast("double").alias("x"))
    monkeypatch.setattr(ranks, "_bracket", lambda r, j: (r["_lo"], r["_lo"]))
    assert values_at_ranks(df, "x", lambda _, n: [7, n // 2, n])[0] == {k: (float(k - 1), k - 1) for k in (7, 2500, 5000)}


def test_two_scans(spark):
    """The selection runs two jobs over the input, whatever the spread of the values."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    df = spark.range(20_000).select(F.col("id"), F.exp(F.col("id") % 600).alias("x")).mapInPandas(count, "id long, x double")
    values_at_ranks(df, "x", lambda _, n: [quantile_rank(n, p) for p in (0.01, 0.5, 0.99)])
    assert seen.value == 40_000


def test_empty_input(spark):
    df = spark.createDataFrame([], "id long, x double")
    assert distributed_ntile(df, "x", "id", 10, "b").count() == 0


def test_no_exchange_at_all(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 37).cast("double").alias("x"))
    plan = distributed_ntile(df, "x", "id", 10, "b")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Join" not in plan
