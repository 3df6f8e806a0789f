"""Distinct counts of a category by bits, against sets counted in Python."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import categories
from ledgerlark.operators.marts import mart_customer_credit_history
from ledgerlark.plans.catalog import Catalog
from ledgerlark.sources.fixtures import fixture_tables
from paths import SF_SMALL


def _counts(df, **how):
    coded, n = categories.distinct_category(df, "x", **how)
    return {r["g"]: r["n"] for r in coded.groupBy("g").agg(n.alias("n")).collect()}


def _rows(values, seed=3, rows=2000):
    rng = random.Random(seed)
    return [(rng.randrange(9), rng.choice(values)) for _ in range(rows)] + [(99, None)]


@pytest.mark.parametrize("n_values", [1, 2, 63, 64, 65, 128, 200])
def test_counts_are_those_of_sets(spark, n_values):
    """One word of bits and several; the first and last bit of a word; empty text, padding and non-ASCII are values."""
    values = ["", " ", "é", "E", "e", None, *(f"type {k}" for k in range(200))][:n_values]
    rows = _rows(values)
    want = {g: len({x for h, x in rows if h == g and x is not None}) for g, _ in rows}
    df = spark.createDataFrame(rows, "g int, x string").repartition(5)
    assert _counts(df) == want
    assert _counts(df, at_most=3) == want  # more values than bits: counted the general way


def test_no_values_at_all(spark):
    schema = "g int, x string"
    assert _counts(spark.createDataFrame([(1, None), (1, None)], schema)) == {1: 0}
    assert _counts(spark.createDataFrame([], schema)) == {}


def test_a_value_that_was_not_listed_ends_the_query(spark, monkeypatch):
    monkeypatch.setattr(categories, "values_of", lambda *_: ["a"])
    df = spark.createDataFrame([(1, "a"), (1, "b")], "g int, x string")
    with pytest.raises(Exception, match="not there when its values were listed: b"):
        _counts(df)


def test_mart_keeps_no_object_aggregate(spark):
    """The customer mart is a hash aggregate, and listing the types reads no history of months."""
    enriched = Catalog(fixture_tables(spark, SF_SMALL), spark=spark).int_bureau_enriched
    plan = mart_customer_credit_history(enriched)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    listing = enriched.select("CREDIT_TYPE").where(F.col("CREDIT_TYPE").isNotNull()).distinct()
    assert "Join" not in listing._jdf.queryExecution().optimizedPlan().toString()
