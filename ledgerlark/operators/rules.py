"""Business-rule audit: named predicates counted in one pass, cohorts, worst offenders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .profile import counters


def rule_counts(df: DataFrame, rules: Mapping[str, Column], total: str = "total_rows") -> DataFrame:
    """``count(*)`` plus one ``countif`` per named rule, all in one aggregate."""
    return counters(df, rules, total=total)


def cohort(df: DataFrame, predicate: Column, aggs: Sequence[Column]) -> DataFrame:
    """Global aggregate over the rows matching ``predicate`` (pushed to the scan)."""
    return df.where(predicate).agg(*aggs)


def top_violations(df: DataFrame, predicate: Column, order: Column, cols: Sequence[str],
                   n: int = 20, tie: str | None = None) -> DataFrame:
    """The ``n`` worst rows matching ``predicate``: a top-k (TakeOrderedAndProject).

    Each task keeps only its own top ``n``; the limit is the feature here.
    ``tie`` makes the order total so the result is deterministic.
    """
    keys = [order] + ([F.col(tie).asc()] if tie else [])
    return df.where(predicate).orderBy(*keys).limit(n).select(*cols)
