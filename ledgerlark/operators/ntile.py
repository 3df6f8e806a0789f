"""``ntile(n) over (order by x nulls first, tie)`` without sorting or shuffling the rows.

Only the last row of each bucket but the last matters: those n - 1 (x, tie)
pairs are found by exact rank selection (:mod:`ranks`) in the lexicographic
order, with two scans. Every row then gets its bucket by comparing it with the
n - 1 pairs, in the scan, so a following aggregate reduces map-side. A hot value
or hot NULLs need no special care.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranks import rows_at_ranks


def bucket_ends(total: int, n: int) -> list[int]:
    """Ranks of the last rows of all buckets but the last; the first ``total % n`` hold one row more."""
    size, more = divmod(total, n)
    ends = [i * size + min(i, more) for i in range(1, n)]
    return [e for e in ends if 0 < e < total]


def distributed_ntile(df: DataFrame, order_col: str, tie_col: str, n: int, out_col: str) -> DataFrame:
    """Add ``out_col`` = ``ntile(n) over (order by order_col nulls first, tie_col)``.

    ``order_col`` is a number (NaN comes last), ``tie_col`` an integer, non-NULL
    and unique. The two counting jobs run when the DataFrame is built.
    """
    x, tie = F.col(order_col), F.col(tie_col)
    last: list[Column] = []
    for value, t in rows_at_ranks(df, order_col, tie_col, lambda total: bucket_ends(total, n)).values():
        later = tie > F.lit(t)
        last.append((x.isNotNull() | later) if value is None else ((x > F.lit(value)) | ((x == F.lit(value)) & later)))
    bucket = F.lit(1)
    for beyond in last:
        bucket = bucket + F.when(beyond, 1).otherwise(0)
    return df.withColumn(out_col, bucket.cast("bigint"))
