"""Generic data-audit operators: grain, completeness, sentinels, profiles, missingness.

Each takes a DataFrame plus column/name parameters and returns a small
DataFrame.  A statement over one table is one aggregate (one scan); the
reference's multi-branch ``UNION ALL`` profiles become one ``unpivot`` of the
listed columns followed by one ``groupBy`` on the column name (numeric) or on
(column name, value) (categorical).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.compat import count_if, exact_avg, not_title_case, pct, safe_div, trim_ws
from .ranks import quantile_table


def _n() -> Column:
    return F.count(F.lit(1))


def grain(df: DataFrame, table_name: str, key: str | Sequence[str], names: Mapping[str, str],
          entity: str | None = None, per_entity_digits: int = 2,
          range_col: str | None = None, null_cols: Mapping[str, str] | None = None) -> DataFrame:
    """Row count, distinct keys, duplicates, entities and key NULLs in one aggregate.

    ``names`` maps the logical outputs (``distinct_keys``, ``duplicates``,
    ``distinct_entities``, ``per_entity``, ``range_min``, ``range_max``) to
    output column names.  A composite ``key`` counts distinct tuples with no
    NULL part, as a ``count(distinct concat(...))`` does (T14).
    """
    keys = [key] if isinstance(key, str) else list(key)
    if len(keys) == 2 and not entity:
        return _nested_grain(df, table_name, keys, names, per_entity_digits, range_col, null_cols)
    n = _n()
    distinct_keys = F.count_distinct(*[F.col(k) for k in keys])
    cols = [F.lit(table_name).alias("table_name"), n.alias("total_rows")]
    if "distinct_first_key" in names:
        cols.append(F.count_distinct(keys[0]).alias(names["distinct_first_key"]))
    cols += [distinct_keys.alias(names["distinct_keys"]), (n - distinct_keys).alias(names["duplicates"])]
    if entity:
        ent = F.count_distinct(entity)
        cols += [ent.alias(names["distinct_entities"]),
                 F.round(safe_div(n, ent), per_entity_digits).alias(names["per_entity"])]
    elif "per_entity" in names:
        first = F.count_distinct(keys[0])
        cols.append(F.round(safe_div(n, first), per_entity_digits).alias(names["per_entity"]))
    if range_col:
        cols += [F.min(range_col).alias(names["range_min"]), F.max(range_col).alias(names["range_max"])]
    for out, c in (null_cols or {}).items():
        cols.append(count_if(F.col(c).isNull()).alias(out))
    return df.agg(*cols)


def _nested_grain(df: DataFrame, table_name: str, keys: Sequence[str], names: Mapping[str, str],
                  per_entity_digits: int, range_col: str | None, null_cols: Mapping[str, str] | None) -> DataFrame:
    """:func:`grain` of a two-part key by nested aggregates: (first, second), then first, then all.

    Two distinct sets in one aggregate would multiply every row (Expand);
    nested groups shuffle each row once, already counted per key.
    """
    first, second = keys
    extra = {c for c in [range_col, *(null_cols or {}).values()] if c and c not in keys}
    if extra:
        raise ValueError("range and NULL columns must be key parts")
    pair = df.groupBy(first, second).agg(_n().alias("_rows"))
    whole = F.col(first).isNotNull() & F.col(second).isNotNull()
    aggs = [F.sum("_rows").alias("_rows"), count_if(whole).alias("_pairs"),
            F.sum(F.when(F.col(second).isNull(), F.col("_rows"))).alias("_null_second")]
    if range_col:
        aggs += [F.min(range_col).alias("_low"), F.max(range_col).alias("_high")]
    one = pair.groupBy(first).agg(*[a for a in aggs])
    total = F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint")
    pairs, firsts = F.coalesce(F.sum("_pairs"), F.lit(0)).cast("bigint"), F.count(first)
    cols = [F.lit(table_name).alias("table_name"), total.alias("total_rows")]
    if "distinct_first_key" in names:
        cols.append(firsts.alias(names["distinct_first_key"]))
    cols += [pairs.alias(names["distinct_keys"]), (total - pairs).alias(names["duplicates"])]
    if "per_entity" in names:
        cols.append(F.round(safe_div(total, firsts), per_entity_digits).alias(names["per_entity"]))
    if range_col:
        cols += [F.min("_low").alias(names["range_min"]), F.max("_high").alias(names["range_max"])]
    for out, c in (null_cols or {}).items():
        part = F.sum(F.when(F.col(first).isNull(), F.col("_rows"))) if c == first else F.sum("_null_second")
        cols.append(F.coalesce(part, F.lit(0)).cast("bigint").alias(out))
    return one.agg(*cols)


def _row_hash(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of a row; rows that compare equal have equal hashes."""
    same = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):  # -0.0 equals 0.0, any NaN any other
            c = F.when(c == 0, F.lit(0.0)).when(F.isnan(c), F.lit(float("nan"))).otherwise(c).cast(f.dataType)
        same.append(c)
    return [F.xxhash64(*same).alias("_h1"), F.xxhash64(F.lit(1), *same).alias("_h2")]


def full_row_duplicates(df: DataFrame) -> DataFrame:
    """Rows, distinct full rows (NULLs compare equal) and identical duplicates (T13).

    Rows are grouped by a hash first, 16 bytes a row. A hash that comes once is
    a distinct row; only the rows of repeated hashes are compared in full, in a
    second scan, so unequal rows that share a hash still count apart.
    """
    hashes = ["_h1", "_h2"]
    groups = df.select(*_row_hash(df)).groupBy(*hashes).agg(_n().alias("_c"))
    once = groups.agg(F.sum("_c").alias("_rows"), count_if(F.col("_c") == 1).alias("_distinct"))
    repeated = groups.where("_c > 1").select(*hashes)
    whole = df.select("*", *_row_hash(df)).join(repeated, hashes, "left_semi").groupBy(*df.columns).agg(_n().alias("_c"))
    more = whole.agg(F.lit(0).cast("bigint").alias("_rows"), _n().alias("_distinct"))
    total = F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint")
    distinct = F.coalesce(F.sum("_distinct"), F.lit(0)).cast("bigint")
    return once.unionByName(more).agg(
        total.alias("total_rows"),
        distinct.alias("distinct_full_rows"),
        (total - distinct).alias("identical_duplicate_rows"),
    )


def null_pct(df: DataFrame, cols: Mapping[str, str], digits: int = 2,
             with_total: bool = True) -> DataFrame:
    """``round(100 * countif(c is null) / count(*), digits)`` per column, one pass."""
    n = _n()
    out = [n.alias("total_rows")] if with_total else []
    out += [pct(count_if(F.col(c).isNull()), n, digits).alias(name) for name, c in cols.items()]
    return df.agg(*out)


def counters(df: DataFrame, predicates: Mapping[str, Column], total: str | None = None) -> DataFrame:
    """Named ``countif`` counters (rule engine, sentinels, blanks) in one aggregate."""
    out = [_n().alias(total)] if total else []
    out += [count_if(p).alias(name) for name, p in predicates.items()]
    return df.agg(*out)


def blank_padded_predicates(col: str, *, empty: str | None = None, blank: str | None = None,
                            padded: str | None = None) -> dict[str, Column]:
    """Empty (``''``), blank (only white space) and padded (differs from its trim)."""
    c = F.col(col)
    out: dict[str, Column] = {}
    if empty:
        out[empty] = c == ""
    if blank:
        out[blank] = trim_ws(c) == ""
    if padded:
        out[padded] = c != trim_ws(c)
    return out


# Output columns of the numeric profile, in the reference's order.
PROFILE_PROBS = [("p01", 0.01), ("p25", 0.25), ("median", 0.50), ("p75", 0.75), ("p99", 0.99)]


def numeric_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: NULL/zero/negative counts, min, p01..p99, max, max/p99 ratio.

    Two scans for all columns: ``unpivot`` to (column_name, value) -- values
    cast to double, as the reference's ``UNION ALL`` coerces -- then the counts
    and a sketch per column in one, and the exact quantiles in the other
    (:mod:`ranks`). Both run when the DataFrame is built; it holds one row per
    column. Sorted by the max/p99 ratio, descending, NULLs last.
    """
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], list(cols), "column_name", "v")
    x = F.col("v")
    prof = quantile_table(long, "v", [p for _, p in PROFILE_PROBS], "column_name", [
        count_if(x.isNull()).alias("null_count"),
        count_if(x == 0).alias("zero_count"),
        count_if(x < 0).alias("negative_count"),
        F.min(x).alias("min_value"),
        F.max(x).alias("max_value"),
    ])
    prof = prof.select(
        F.col("_g").alias("column_name"), "null_count", "zero_count", "negative_count", "min_value",
        *[F.col("_q")[j].alias(name) for j, (name, _) in enumerate(PROFILE_PROBS)],
        "max_value",
    )
    ratio = F.round(safe_div(F.col("max_value"), F.nullif(F.col("p99"), F.lit(0.0))), 1)
    return prof.withColumn("max_to_p99_ratio", ratio).orderBy(F.col("max_to_p99_ratio").desc_nulls_last())


def category_profile(df: DataFrame, cols: Sequence[str], rare: float = 0.01) -> DataFrame:
    """Per (column, value): count, share of the column, hidden/inner space, case, rarity.

    ``unpivot`` + one ``groupBy`` instead of one scan per column; the column
    totals come from the aggregated (column, value) rows.
    """
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], list(cols), "column_name", "value")
    counts = long.groupBy("column_name", "value").agg(_n().alias("row_count"))
    # the totals have one row per column; a window would gather every distinct value of a column in one task
    totals = counts.groupBy("column_name").agg(F.sum("row_count").alias("_total"))
    col_total = F.col("_total")
    v = F.col("value")
    return counts.join(F.broadcast(totals), "column_name").select(
        "column_name", "value", "row_count",
        F.round(safe_div(F.lit(100) * F.col("row_count"), col_total), 4).alias("pct_of_column"),
        (v != trim_ws(v)).alias("has_hidden_whitespace"),
        (F.instr(trim_ws(v), " ") > 0).alias("contains_inner_space"),
        not_title_case(v).alias("not_title_case"),
        (F.col("row_count") < F.lit(rare) * col_total).alias("is_rare_category"),
    ).orderBy("column_name", F.col("row_count").desc())


def spelling_variants(df: DataFrame, col: str, sep: str = " | ") -> DataFrame:
    """Normalised values (lower, trimmed) that have more than one raw spelling.

    ``collect_set`` is bounded by the distinct spellings of one normalised
    value and partial-aggregates map-side, so no group's rows reach one task.
    """
    spellings = F.array_sort(F.collect_set(col))
    return (df.groupBy(F.lower(trim_ws(F.col(col))).alias("normalised_value"))
            .agg(spellings.alias("_s"))
            .select("normalised_value",
                    F.size("_s").cast("bigint").alias("distinct_raw_spellings"),
                    F.array_join("_s", sep).alias("the_spellings"))
            .where(F.col("distinct_raw_spellings") > 1))


def value_distribution(df: DataFrame, col: str, allowed: Sequence[str], digits: int = 2) -> DataFrame:
    """Per value: count, % of all rows, length, and whether it is outside ``allowed``."""
    counts = df.groupBy(col).agg(_n().alias("row_count"))
    total = counts.agg(F.sum("row_count")).scalar()
    # the total is one number; a window over all values would gather them in one task
    return counts.select(
        col, "row_count",
        F.round(safe_div(F.lit(100) * F.col("row_count"), total), digits).alias("pct_of_rows"),
        F.length(col).alias("character_length"),
        (~F.col(col).isin(list(allowed))).alias("is_unexpected_value"),
    ).orderBy(F.col("row_count").desc())


def missingness_by(df: DataFrame, group: Column, group_name: str, count_name: str,
                   measures: Mapping[str, tuple[Column, int]],
                   extra: Mapping[str, Column] | None = None, order: str | None = None) -> DataFrame:
    """Group rows and report, per group, ``round(100 * countif(pred) / count(*), d)``.

    ``measures``: output name -> (predicate, digits); ``extra``: plain counters.
    """
    n = _n()
    aggs = [n.alias(count_name)]
    aggs += [count_if(p).alias(k) for k, p in (extra or {}).items()]
    aggs += [pct(count_if(p), n, d).alias(k) for k, (p, d) in measures.items()]
    out = df.groupBy(group.alias(group_name)).agg(*aggs)
    if order == "count_desc":
        out = out.orderBy(F.col(count_name).desc())
    elif order == "group":
        out = out.orderBy(group_name)
    return out


def mean_by(df: DataFrame, group: str, cols: Mapping[str, str], count_name: str,
            digits: int = 2) -> DataFrame:
    """Per group: row count and ``round(avg(c), digits)`` for each column (order-independent mean)."""
    aggs = [_n().alias(count_name)]
    aggs += [F.round(exact_avg(c), digits).alias(out) for out, c in cols.items()]
    return df.groupBy(group).agg(*aggs).orderBy(group)
