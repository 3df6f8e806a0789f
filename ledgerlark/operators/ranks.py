"""Exact order statistics in two scans of the input, without sorting or gathering it.

The first scan keeps a mergeable quantile sketch per group (Spark's
``percentile_approx``), which brackets every wanted rank between two values a
few ten-thousandths of the rows apart. The second scan counts exactly: rows
below, between and above the brackets are one count each, rows inside a bracket
are counted per value. The wanted value then follows from these counts. A
bracket that turned out not to hold its rank (the sketch promises that it does)
is widened to the whole group and counted again, so the answer never rests on
the sketch. Brackets of few rows end on the driver; larger ones are written,
sorted by range and summed per partition.

With a tie key the order is lexicographic, (value, key), in the same two scans.
Values order as Spark orders them: -infinity, numbers, infinity, NaN.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Hashable, Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

#: The sketch's rank error is at most rows / ACCURACY.
ACCURACY = 10_000
#: Distance of a bracket's ends from the wanted rank, as a share of the rows: for many rows, and for fewer.
NARROW, WIDE = 2 / ACCURACY, 0.02
#: Groups and wanted ranks kept on the driver and broadcast at most; more is an error, not a silent cut.
MAX_TARGETS = 50_000
#: Groups times brackets that are compared as literals; more are joined.
MAX_LITERALS = 128
#: Counted values that the driver takes; brackets with more of them are sorted by Spark.
MAX_COLLECTED = 200_000

Ranks = Callable[[Hashable, int], Sequence[int]]
#: Sorted, disjoint (low, high) brackets.
Brackets = list[tuple[float, float]]

_LOWEST = float("-inf")


def _order(v: float | int | None) -> tuple:
    """Sort key of a value as Spark orders it, NULL first."""
    nan = isinstance(v, float) and math.isnan(v)
    return (v is not None, nan, 0 if v is None or nan else v)


def _merged(ends: Iterable[tuple[float, float]]) -> Brackets:
    out: Brackets = []
    for lo, hi in sorted(ends, key=lambda e: (_order(e[0]), _order(e[1]))):
        if out and _order(lo) <= _order(out[-1][1]):
            out[-1] = (out[-1][0], max(out[-1][1], hi, key=_order))
        else:
            out.append((lo, hi))
    return out


def _bracket(r: Row, j: int) -> tuple[float, float]:
    """The bracket of the j-th wanted rank: narrow where its width is some rows, else wide, else the whole group."""
    lo, hi, low, high = r["_s"][4 * j : 4 * j + 4]
    if r["_n"] * NARROW >= 8:
        return lo, hi
    return (low, high) if r["_n"] * WIDE >= 8 else (r["_lo"], r["_hi"])


def _local(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A small table as part of the plan: no job reads it."""
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    table = pa.table([pa.array(list(c)) for c in columns], names=[f.name for f in schema])
    return spark.createDataFrame(table, schema)


def _literal_segment(own: Brackets) -> Column:
    """2 j for ``s`` below bracket j, 2 j + 1 inside it; as text, since one call per literal would take longer than the scan."""
    number = lambda x: f"cast('{float(x)!r}' as double)"
    return F.expr(" + ".join(f"int(s >= {number(lo)}) + int(s > {number(hi)})" for lo, hi in own))


def _counted(rows: DataFrame, brackets: dict[Hashable, Brackets], grouped: bool) -> DataFrame:
    """``g, seg, v, t, c``: rows per value (and tie key) inside a bracket, per segment (``v``, ``t`` NULL) outside."""
    if not grouped:
        seg = _literal_segment(brackets[0])
    elif sum(map(len, brackets.values())) <= MAX_LITERALS:
        seg = F.lit(None).cast("int")
        for g, own in brackets.items():
            seg = F.when(F.col("g").eqNullSafe(F.lit(g)), _literal_segment(own)).otherwise(seg)
        rows = rows.select("*", seg.alias("seg")).where("seg IS NOT NULL")
        seg = F.col("seg")
    else:
        schema = T.StructType([T.StructField("h", rows.schema["g"].dataType), T.StructField("lows", T.ArrayType(T.DoubleType())), T.StructField("highs", T.ArrayType(T.DoubleType()))])
        table = _local(rows.sparkSession, [(g, [b[0] for b in own], [b[1] for b in own]) for g, own in brackets.items()], schema)
        rows = rows.join(F.broadcast(table), rows["g"].eqNullSafe(table["h"]))
        seg = F.expr("size(filter(lows, x -> s >= x)) + size(filter(highs, x -> s > x))")
    inside = F.col("seg") % 2 == 1
    cut = rows.select("g", seg.alias("seg"), "v", "t").select("g", "seg", F.when(inside, F.col("v")).alias("v"), F.when(inside, F.col("t")).alias("t"))
    return cut.groupBy("g", "seg", "v", "t").agg(F.count(F.lit(1)).alias("c"))


def _found(counts: Iterable[tuple], wanted: Sequence[int]) -> dict[int, tuple] | None:
    """``{rank: (value, tie, rows before)}`` from the counts (seg, v, t, c) of a group in order; None if a rank lies outside the brackets."""
    out, todo, before = {}, sorted(set(wanted)), 0
    for seg, v, t, c in counts:
        while todo and todo[0] <= before + c:
            if seg % 2 == 0:
                return None
            out[todo.pop(0)] = (v, t, before)
        before += c
    return out if not todo else None


def _from_small(table: list[Row], wanted: dict[Hashable, Sequence[int]]) -> dict[Hashable, dict[int, tuple] | None]:
    own: dict[Hashable, list[tuple]] = {}
    for r in table:
        own.setdefault(r["g"], []).append((r["seg"], r["v"], r["t"], r["c"]))
    ordered = {g: sorted(own.get(g, []), key=lambda x: (x[0], _order(x[1]), _order(x[2]))) for g in wanted}
    return {g: _found(ordered[g], ks) for g, ks in wanted.items()}


def _from_large(counts: DataFrame, wanted: dict[Hashable, Sequence[int]]) -> dict[Hashable, dict[int, tuple] | None]:
    """As :func:`_from_small`, for brackets of any size.

    The counts are written sorted by range, with the number of the range; one sum
    per range and segment tells the range that holds a rank, and only those
    ranges are summed up value by value.
    """
    spark = counts.sparkSession
    keys = [F.col(c).asc_nulls_first() for c in ("g", "seg", "v", "t")]
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerlark-ranks/{uuid.uuid4().hex}"
    ranged = counts.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id())
    ranged.write.parquet(path)
    table = spark.read.schema(ranged.schema).parquet(path)
    spans: dict[Hashable, list[Row]] = {}
    for r in table.groupBy("g", "seg", "part").agg(F.sum("c").alias("c")).collect():  # ranges plus segments
        spans.setdefault(r["g"], []).append(r)
    out: dict[Hashable, dict[int, tuple] | None] = {}
    asked = []
    for g, ks in wanted.items():
        out[g], before = {}, 0
        todo = sorted(set(ks))
        for r in sorted(spans.get(g, []), key=lambda r: (r["seg"], r["part"])):
            while todo and out[g] is not None and todo[0] <= before + r["c"]:
                if r["seg"] % 2 == 0:
                    out[g] = None
                    break
                asked.append((g, r["seg"], r["part"], todo.pop(0), before))
            before += r["c"]
        if todo:
            out[g] = None
    if asked:
        schema = T.StructType([T.StructField("h", counts.schema["g"].dataType), *[T.StructField(c, k) for c, k in (("seg", T.IntegerType()), ("part", T.IntegerType()), ("k", T.LongType()), ("first", T.LongType()))]])
        targets = _local(spark, asked, schema)
        parts = sorted({a[2] for a in asked})
        window = Window.partitionBy("part", "g", "seg").orderBy(F.col("v").asc_nulls_first(), F.col("t").asc_nulls_first())
        summed = table.where(F.col("part").isin(parts)).withColumn("upto", F.sum("c").over(window))
        met = summed.join(F.broadcast(targets), ["seg", "part"]).where(F.col("g").eqNullSafe(F.col("h")))
        met = met.where((F.col("first") + F.col("upto") >= F.col("k")) & (F.col("first") + F.col("upto") - F.col("c") < F.col("k")))
        for r in met.collect():
            out[r["g"]][r["k"]] = (r["v"], r["t"], r["first"] + r["upto"] - r["c"])
    return out


def _selected(df: DataFrame, value: str, ranks: Ranks, group: str | None, tie: str | None, nulls_first: bool,
              aggs: Sequence[Column]) -> tuple[dict[Hashable, dict[int, tuple]], dict[Hashable, Row], T.StructType]:
    """Per group ``{rank: (value, tie, rows before)}``, and the first scan's row with the ``aggs``."""
    whole = isinstance(df.schema[value].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    v = F.col(value).cast("bigint" if whole else "double")
    # the sketch's key: monotone in the value, NULL lowest where it has a rank
    s = F.coalesce(v.cast("double"), F.lit(_LOWEST)) if nulls_first else v.cast("double")
    shares = [k / 10**9 for k in ranks(None, 10**9)]  # where the wanted ranks lie in a large group
    at = [min(1.0, max(0.0, p + d)) for p in shares for d in (-NARROW, NARROW, -WIDE, WIDE)] or [0.5]
    g = F.col(group) if group else F.lit(0)
    sketch = F.expr(f"percentile_approx(_key, array({', '.join(f'{p!r}D' for p in at)}), {ACCURACY})")
    first = df.withColumn("_key", s).groupBy(g.alias("g")).agg(
        F.count("_key").alias("_n"), F.min("_key").alias("_lo"), F.max("_key").alias("_hi"), sketch.alias("_s"), *aggs)
    seen = {r["g"]: r for r in first.limit(MAX_TARGETS + 1).collect()}
    wanted = {g: [k for k in ranks(g, r["_n"]) if 1 <= k <= r["_n"]] for g, r in seen.items()}
    wanted = {g: ks for g, ks in wanted.items() if ks}
    if len(seen) + sum(map(len, wanted.values())) > MAX_TARGETS:
        raise ValueError(f"more than {MAX_TARGETS} groups and ranks")
    out: dict[Hashable, dict[int, tuple]] = {g: {} for g in seen}
    rows = df.select(g.alias("g"), v.alias("v"), (F.col(tie).cast("bigint") if tie else F.lit(None).cast("bigint")).alias("t"), s.alias("s"))
    rows = rows if nulls_first else rows.where("s IS NOT NULL")
    brackets = {g: _merged(_bracket(seen[g], j) for j in range(len(shares))) for g in wanted}
    while wanted:
        # rows that the brackets hold, ties aside
        width = sum(len(own) * 2 * seen[g]["_n"] * NARROW for g, own in brackets.items())
        counts = _counted(rows, {g: brackets[g] for g in wanted}, group is not None)
        small = counts.limit(MAX_COLLECTED + 1).collect() if width <= MAX_COLLECTED / 2 else None
        if small is not None and len(small) <= MAX_COLLECTED:
            found = _from_small(small, wanted)
        else:
            found = _from_large(counts, wanted)
        out |= {g: own for g, own in found.items() if own is not None}
        wanted = {g: ks for g, ks in wanted.items() if found[g] is None}
        brackets |= {g: [(seen[g]["_lo"], seen[g]["_hi"])] for g in wanted}
    return out, seen, first.schema


def values_at_ranks(df: DataFrame, value: str, ranks: Ranks, group: str | None = None) -> dict[Hashable, dict[int, tuple]]:
    """Per group, ``{rank: (value, rows before it)}`` for the 1-based ``ranks(group, non-NULL rows)``.

    NULL values have no rank; a NULL group is a group. ``value`` is an integer
    column, or any other number, taken as double. Runs its two jobs right away.
    """
    found, _, _ = _selected(df, value, ranks, group, None, False, ())
    return {g: {k: (v, before) for k, (v, _, before) in own.items()} for g, own in found.items()}


def rows_at_ranks(df: DataFrame, value: str, tie: str, ranks: Callable[[int], Sequence[int]]) -> dict[int, tuple]:
    """``{rank: (value, tie)}`` of the rows in the order (value NULLs first, tie) at the 1-based ``ranks(rows)``.

    ``tie`` is an integer, non-NULL and unique.
    """
    found, _, _ = _selected(df, value, lambda _, n: ranks(n), None, tie, True, ())
    return {k: (v, t) for own in found.values() for k, (v, t, _) in own.items()}


def quantile_rank(n: int, p: float) -> int:
    """1-based rank of the discrete quantile ``p`` of ``n`` values."""
    return max(1, n - math.floor(n - p * n))


def quantile_table(df: DataFrame, value: str, probs: Sequence[float], group: str, aggs: Sequence[Column] = ()) -> DataFrame:
    """``_g, _q`` and the ``aggs``: the discrete quantiles of ``value`` per group, in the order of ``probs``.

    A small local table (one row per group; ``_q`` is NULL where all values
    are), to be broadcast onto the groups' other aggregates. The ``aggs`` are
    taken along in the first scan.
    """
    found, seen, schema = _selected(df, value, lambda _, n: [quantile_rank(n, p) for p in probs], group, None, False, aggs)
    names = [f.name for f in schema.fields[5:]]
    rows = []
    for g, r in seen.items():
        q = [float(found[g][quantile_rank(r["_n"], p)][0]) for p in probs] if r["_n"] else None
        rows.append((g, q, *[r[c] for c in names]))
    out = T.StructType([T.StructField("_g", df.schema[group].dataType), T.StructField("_q", T.ArrayType(T.DoubleType())), *schema.fields[5:]])
    return _local(df.sparkSession, rows, out)
