"""Integrity operators against brute force on small fixtures with NULL keys."""

from __future__ import annotations

from ledgerlark.operators import integrity as ig


def test_key_coverage_brute_force(spark):
    b = [(1,), (2,), (2,), (3,), (None,)]
    bb = [(2,), (2,), (3,), (4,), (5,), (None,)]
    out = ig.key_coverage(spark.createDataFrame(b, "SK_ID_BUREAU long"),
                          spark.createDataFrame(bb, "SK_ID_BUREAU long"), "SK_ID_BUREAU").first()
    bk = {x for (x,) in b if x is not None}
    bbk = {x for (x,) in bb if x is not None}
    assert out.loans_in_bureau == len(bk)
    assert out.loans_in_balance == len(bbk)
    assert out.orphan_loans_in_balance == len(bbk - bk)
    assert out.loans_without_any_history == len(bk - bbk)
    assert out.bureau_row_count == len(b)


def test_customer_coverage_counts_null_once(spark):
    b = spark.createDataFrame([(1,), (1,), (2,), (None,)], "SK_ID_CURR long")
    tr = spark.createDataFrame([(2,), (3,)], "SK_ID_CURR long")
    te = spark.createDataFrame([(3,), (4,), (None,)], "SK_ID_CURR long")
    r = ig.customer_coverage(b, tr, te, key="SK_ID_CURR").first()
    # b = {1, 2, NULL}; apps = {2, 3, 4, NULL}; NULL never matches
    assert (r.customers_in_bureau, r.customers_in_applications) == (3, 4)
    assert (r.bureau_customers_not_in_applications, r.applicants_without_bureau_history) == (2, 3)


def test_fanout_and_join_rowcount(spark):
    bb = spark.createDataFrame([(1,), (1,), (2,), (None,)], "SK_ID_BUREAU long")
    f = ig.fanout(bb, "SK_ID_BUREAU").first()
    assert (f.summary_rows, f.distinct_loans, f.max_rows_per_loan, f.loans_appearing_more_than_once) == (3, 2, 2, 1)
    b = spark.createDataFrame([(1,), (3,)], "SK_ID_BUREAU long")
    j = ig.join_rowcount(b, bb, "SK_ID_BUREAU").first()
    assert (j.rows_before_join, j.rows_after_join) == (2, 2)


def test_join_rowcount_runs_the_join(spark):
    """Both sides are scanned and joined, and a summary with two rows per loan would show."""
    import __spark_entry__ as entry
    from paths import SF_SMALL
    from ledgerlark.operators import checks as ck

    for key in ("an06_join_rowcount", "check_join_preserves_rows"):
        plan = entry.queries()[key](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert "Join LeftOuter" in plan and "l_linenumber" in plan and "o_orderkey" in plan
    left = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    joined = spark.createDataFrame([(1, True), (1, True), (2, False), (None, False)], "k long, has_monthly_history boolean")
    assert ck.check_join_preserves_rows(left, joined, "k", "m").first().failures == 2
    assert ck.check_join_preserves_rows(left, joined.dropDuplicates(), "k", "m").first().failures == 0


def test_nested_grain(spark):
    from ledgerlark.operators import profile as pf

    rows = [(1, 1), (1, 1), (1, 2), (2, 1), (None, 1), (3, None), (3, None), (None, None)]
    names = {"distinct_first_key": "a", "distinct_keys": "b", "duplicates": "c", "per_entity": "d", "range_min": "lo", "range_max": "hi"}
    make = lambda r: pf.grain(spark.createDataFrame(r, "k long, m long"), "t", ["k", "m"], names, range_col="m",
                              null_cols={"nk": "k", "nm": "m"}).first().asDict()
    assert make(rows) == {"table_name": "t", "total_rows": 8, "a": 3, "b": 3, "c": 5, "d": 2.67, "lo": 1, "hi": 2, "nk": 2, "nm": 3}
    assert make([])["total_rows"] == 0
