"""Declared data checks as Spark jobs that count violations (0 = pass).

Each check returns rows ``(model, column_name, failures)``; several
instances are unioned into one report.  Failure counts follow the usual
test-query semantics: ``unique`` counts duplicated values, ``not_null``
counts NULL rows, ``accepted_values`` counts distinct unexpected values,
``accepted_range`` counts rows outside the range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.compat import count_if


def _rows(model: str, pairs: list[tuple[str, Column]], df: DataFrame) -> DataFrame:
    """One aggregate over ``df`` producing one row per (column, failure count)."""
    wide = df.agg(*[c.alias(f"f{i}") for i, (_, c) in enumerate(pairs)])
    rows = F.array(*[
        F.struct(F.lit(model).alias("model"), F.lit(name).alias("column_name"),
                 F.col(f"f{i}").cast("bigint").alias("failures"))
        for i, (name, _) in enumerate(pairs)
    ])
    return wide.select(F.inline(rows))


def check_unique(df: DataFrame, col: str, model: str) -> DataFrame:
    """Number of non-NULL values that occur more than once (partial-aggregated count per value)."""
    dup = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return _rows(model, [(col, F.count(F.lit(1)))], dup)


def check_not_null(df: DataFrame, cols: Sequence[str], model: str) -> DataFrame:
    """NULL rows per column, all columns of a table in one pass."""
    return _rows(model, [(c, count_if(F.col(c).isNull())) for c in cols], df)


def check_accepted_values(df: DataFrame, col: str | Column, values: Sequence, model: str,
                          name: str | None = None, where: Column | None = None) -> DataFrame:
    """Distinct non-NULL values outside ``values`` (optionally after a row filter)."""
    c = F.col(col) if isinstance(col, str) else col
    src = df.where(where) if where is not None else df
    bad = src.select(c.alias("_v")).where(~F.col("_v").isin(list(values))).groupBy("_v").count()
    return _rows(model, [(name or str(col), F.count(F.lit(1)))], bad)


def check_accepted_range(df: DataFrame, col: str, model: str, min_value=None, max_value=None,
                         where: Column | None = None) -> DataFrame:
    """Rows whose value is outside [min_value, max_value] (NULL is not a failure)."""
    c = F.col(col)
    ok = F.lit(True)
    if min_value is not None:
        ok = ok & (c >= F.lit(min_value))
    if max_value is not None:
        ok = ok & (c <= F.lit(max_value))
    src = df.where(where) if where is not None else df
    return _rows(model, [(col, count_if(~ok))], src)


def check_join_preserves_rows(left: DataFrame, joined: DataFrame, key: str, model: str,
                              hit: str = "has_monthly_history") -> DataFrame:
    """A left join onto a per-key summary must keep the row count and the key unique.

    failures = |rows(joined) - rows(left)| + duplicated keys in ``joined``.
    ``hit`` is a flag that the join sets (never NULL); the joined rows are
    counted by it, so that the join is really run.
    """
    dup = check_unique(joined, key, model).select(F.col("failures").alias("_dup"))
    counts = (left.select(F.lit(1).alias("_l"), F.lit(None).cast("boolean").alias("_hit"))
              .unionByName(joined.select(F.lit(0).alias("_l"), F.col(hit).alias("_hit")))
              .agg(F.sum("_l").alias("_nl"), (count_if(F.col("_hit")) + count_if(~F.col("_hit"))).alias("_nj")))
    both = counts.unionByName(dup, allowMissingColumns=True).agg(
        F.max("_nl").alias("_nl"), F.max("_nj").alias("_nj"), F.max("_dup").alias("_dup"))
    return both.select(
        F.lit(model).alias("model"), F.lit(key).alias("column_name"),
        (F.abs(F.coalesce("_nj", F.lit(0)) - F.coalesce("_nl", F.lit(0))) + F.col("_dup"))
        .cast("bigint").alias("failures"))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
