"""Referential-integrity audit: key coverage, fan-out, join row counts.

The reference writes these as scalar subqueries side by side.  Here each
figure comes from one aggregate over a join of *distinct keys* (each side
reduced by a partial aggregate before it is shuffled), and several one-row
results are combined by ``side_by_side`` (a union of one-row frames, no
cross join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.compat import count_if


def side_by_side(*frames: DataFrame) -> DataFrame:
    """Combine one-row frames with disjoint columns into one row."""
    names = [c for f in frames for c in f.columns]
    types = {f.name: f.dataType for fr in frames for f in fr.schema.fields}
    padded = [
        fr.select(*[(F.col(c) if c in fr.columns else F.lit(None).cast(types[c])).alias(c) for c in names])
        for fr in frames
    ]
    u = padded[0]
    for p in padded[1:]:
        u = u.unionByName(p)
    return u.agg(*[F.max(c).alias(c) for c in names])


def key_coverage(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys on each side, keys only on one side, and left row count.

    ``left`` is the master table (e.g. bureau), ``right`` the detail table
    (e.g. its monthly balance).  One full outer join of the two distinct-key
    sets; NULL keys never match and are not counted as keys.
    """
    lk = left.groupBy(F.col(key).alias("_lk")).agg(F.count(F.lit(1)).alias("_rows"))
    rk = right.groupBy(F.col(key).alias("_rk")).agg(F.lit(True).alias("_in_r"))
    j = lk.join(rk, lk["_lk"] == rk["_rk"], "full_outer")
    in_l, in_r = j["_lk"].isNotNull(), j["_rk"].isNotNull()
    return j.agg(
        count_if(in_l).alias("loans_in_bureau"),
        count_if(in_r).alias("loans_in_balance"),
        count_if(in_r & ~in_l).alias("orphan_loans_in_balance"),
        count_if(in_l & ~in_r).alias("loans_without_any_history"),
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("bureau_row_count"),
    )


def fanout(df: DataFrame, key: str) -> DataFrame:
    """Rows per key: how many groups, distinct keys, max rows, keys seen more than once."""
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows_per_loan"))
    return per.agg(
        F.count(F.lit(1)).alias("summary_rows"),
        F.count(key).alias("distinct_loans"),  # keys are unique after the groupBy
        F.max("rows_per_loan").alias("max_rows_per_loan"),
        count_if(F.col("rows_per_loan") > 1).alias("loans_appearing_more_than_once"),
    )


def customer_coverage(master: DataFrame, *applicant_tables: DataFrame, key: str) -> DataFrame:
    """Distinct customers in ``master`` vs the union of applicant tables, both ways.

    ``select distinct`` keeps one NULL row per side, and a NULL never matches,
    exactly as the left-join-and-IS-NULL subqueries of the reference count it.
    """
    b = master.select(F.col(key).alias("_bk")).distinct().withColumn("_in_b", F.lit(True))
    apps = applicant_tables[0].select(key)
    for t in applicant_tables[1:]:
        apps = apps.union(t.select(key))
    a = apps.distinct().select(F.col(key).alias("_ak"), F.lit(True).alias("_in_a"))
    j = b.join(a, b["_bk"] == a["_ak"], "full_outer")
    in_b, in_a = j["_in_b"].isNotNull(), j["_in_a"].isNotNull()
    return j.agg(
        count_if(in_b).alias("customers_in_bureau"),
        count_if(in_a).alias("customers_in_applications"),
        count_if(in_b & ~in_a).alias("bureau_customers_not_in_applications"),
        count_if(in_a & ~in_b).alias("applicants_without_bureau_history"),
    )


def join_rowcount(left: DataFrame, detail: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` before and after a left join to ``detail`` summarised per key.

    The rows after are counted as matched plus unmatched ones, from a column of
    the right-hand side, so that the join is really run and measured.
    """
    summary = detail.groupBy(F.col(key).alias("_sk")).agg(F.count(F.lit(1)).alias("months"))
    after = left.join(summary, left[key] == summary["_sk"], "left")
    return side_by_side(
        left.agg(F.count(F.lit(1)).alias("rows_before_join")),
        after.agg((F.count("months") + count_if(F.col("months").isNull())).alias("rows_after_join")),
    )
