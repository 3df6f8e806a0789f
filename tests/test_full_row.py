"""Distinct full rows by row hash: equal to a grouping of whole rows, and 16 bytes a row in the shuffle."""

from __future__ import annotations

import random

from ledgerlark.operators import profile as pf


def test_against_whole_rows(spark):
    rng = random.Random(3)
    nan = float("nan")
    rows = [(rng.choice([1, 2, None]), rng.choice(["a", "b", "", None]), rng.choice([0.0, -0.0, nan, None, 1.5])) for _ in range(400)]
    rows += [(i, f"row {i}", float(i)) for i in range(500)]
    df = spark.createDataFrame(rows, "k long, s string, x double").repartition(5)
    got = pf.full_row_duplicates(df).first()
    assert (got.total_rows, got.distinct_full_rows) == (900, df.distinct().count())
    assert got.identical_duplicate_rows == 900 - got.distinct_full_rows > 0


def test_unequal_rows_with_one_hash_count_apart(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(pf, "_row_hash", lambda df: [F.lit(1).cast("bigint").alias("_h1"), F.lit(2).cast("bigint").alias("_h2")])
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, None)], "k long, s string")
    assert tuple(pf.full_row_duplicates(df).first()) == (4, 3, 1)


def test_empty(spark):
    assert tuple(pf.full_row_duplicates(spark.createDataFrame([], "k long, x double")).first()) == (0, 0, 0)


def test_only_hashes_are_shuffled_for_all_rows(spark):
    df = spark.range(100).selectExpr("id", "cast(id as string) s", "id * 2 as b")
    plan = pf.full_row_duplicates(df)._jdf.queryExecution().optimizedPlan().toString()
    first = next(line for line in plan.splitlines() if "Aggregate [_h1" in line)
    assert "_c" in first and "id" not in first.split("]")[0]
