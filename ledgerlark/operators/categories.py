"""Distinct counts of a category: its values become bits of a few integers.

``count(distinct x)`` per group either ships every (group, value) pair through
an exchange of its own or keeps a set per group, which Spark holds in an object
aggregate that turns to sorting after a hundred or so groups. A category has
few values, so one pass lists them, each becomes the number of a bit, and a
group keeps the union of its bits: plain integers in a hash aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values that the bits are made for; a column with more is counted by ``count(distinct)``.
MAX_VALUES = 512
_BITS = 64


def values_of(df: DataFrame, name: str, at_most: int = MAX_VALUES) -> list[str] | None:
    """The non-NULL values of a text column in order, or None if there are more than ``at_most``.

    A job of its own, over that column alone; no more than ``at_most + 1`` values reach the driver.
    """
    found = df.select(name).where(F.col(name).isNotNull()).distinct().limit(at_most + 1).collect()
    return sorted(r[0] for r in found) if len(found) <= at_most else None


def distinct_category(df: DataFrame, name: str, at_most: int = MAX_VALUES) -> tuple[DataFrame, Column]:
    """``df`` with a column ``_code_<name>``, and the aggregate that counts ``name``'s distinct values from it.

    NULL counts for nothing, a group without values gives 0. The count is that
    of the rows listed here: a value that appears only later, in a source that
    changes, ends the query with an error instead of being left out.
    """
    x = F.col(name)
    values = values_of(df, name, at_most)
    if values is None:
        return df, F.count_distinct(x)
    if not values:
        return df, F.count(x)
    at = F.array_position(F.array(*[F.lit(v) for v in values]), x)
    late = F.raise_error(F.concat(F.lit(f"{name} has a value that was not there when its values were listed: "), x))
    code = f"_code_{name}"
    coded = df.withColumn(code, F.when(at > 0, (at - 1).cast("int")).when(x.isNotNull(), late.cast("int")))
    total = F.lit(0).cast("bigint")
    for word in range(0, len(values), _BITS):
        # A shift takes its distance modulo 64.
        own = F.col(code).between(word, word + _BITS - 1)
        bits = F.bit_or(F.when(own, F.expr(f"shiftleft(1L, `{code}`)")))
        total = total + F.coalesce(F.bit_count(bits), F.lit(0))
    return coded, total.cast("bigint")
