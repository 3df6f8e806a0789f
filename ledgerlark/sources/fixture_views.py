"""How the driver's TPC-H-style test data becomes the credit source tables.

One spec per source table (FIXTURES.md section 3), shared by the Spark loader
(``fixtures.py``) and the DuckDB oracle (``ledgerlark.oracle``), so both
engines derive identical inputs.  ``{DAYS}`` stands for the days from
``o_orderdate`` to 2001-12-01 and is filled in per dialect.

Fixed values: every constant below is part of the fixture definition.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Dialect-specific fragments.  Spark's ``o_orderdate`` day number is supplied
# by the loader as the column ``_o_day`` (see fixtures.py) so that it does not
# depend on the session time zone.
DAYS = {
    "spark": "CAST(datediff(DATE'2001-12-01', _o_day) AS BIGINT)",
    "duckdb": "datediff('day', CAST(o_orderdate AS DATE), DATE '2001-12-01')",
}
CHAR1 = {"spark": "STRING", "duckdb": "VARCHAR"}


@dataclass(frozen=True)
class ViewSpec:
    name: str
    base: str                      # driver table the rows come from
    columns: list[tuple[str, str]]  # (output name, SQL expression)
    join_orders: bool = False      # lineitem JOIN orders ON l_orderkey = o_orderkey
    where: str | None = None
    distinct: bool = False
    needs: tuple[str, ...] = field(default_factory=tuple)  # driver tables read

    def exprs(self, dialect: str) -> list[tuple[str, str]]:
        return [
            (n, e.replace("{DAYS}", DAYS[dialect]).replace("{CHAR1}", CHAR1[dialect]))
            for n, e in self.columns
        ]


APPLICATION_TRAIN = ViewSpec(
    "application_train", "customer",
    [
        ("SK_ID_CURR", "c_custkey"),
        ("TARGET", "CAST(CASE WHEN (c_custkey*31) % 100 < 8 THEN 1 ELSE 0 END AS BIGINT)"),
        ("EXT_SOURCE_1", "CASE WHEN c_custkey % 16 >= 7 THEN NULL ELSE (c_custkey % 1000) / 1000E0 END"),
        ("EXT_SOURCE_2", "CASE WHEN c_custkey % 500 = 3 THEN NULL ELSE (c_custkey*7 % 1000) / 1000E0 END"),
        ("EXT_SOURCE_3", "CASE WHEN c_custkey % 5 = 2 THEN NULL ELSE (c_custkey*13 % 1000) / 1000E0 END"),
        ("AMT_INCOME_TOTAL", "CASE WHEN c_custkey % 701 = 5 THEN CAST(NULL AS DOUBLE) "
                             "ELSE CAST(25650 + (c_custkey*7919 % 400)*1125 AS DOUBLE) END"),
        ("AMT_CREDIT", "CASE WHEN c_custkey % 700 = 13 THEN 0E0 "
                       "ELSE CAST(45000 + (c_custkey*104729 % 800)*1350 AS DOUBLE) END"),
        ("AMT_ANNUITY", "CASE WHEN c_custkey % 500 = 7 THEN CAST(NULL AS DOUBLE) "
                        "ELSE CAST(1615 + (c_custkey*613 % 1000)*50 AS DOUBLE) END"),
        ("DAYS_BIRTH", "-(7489 + (c_custkey*4447 % 17740))"),
        ("DAYS_EMPLOYED", "CASE WHEN c_custkey % 6 = 0 THEN 365243 ELSE -(c_custkey*97 % 17912) END"),
        ("OCCUPATION_TYPE", "CASE WHEN c_custkey % 10 < 3 THEN NULL WHEN c_custkey % 10 < 7 THEN 'BUILDING' "
                            "ELSE c_mktsegment END"),
        ("NAME_EDUCATION_TYPE", "CASE c_nationkey % 5 WHEN 0 THEN 'Academic degree' "
                                "WHEN 1 THEN 'Higher education' WHEN 2 THEN 'Incomplete higher' "
                                "WHEN 3 THEN 'Lower secondary' ELSE 'Secondary / secondary special' END"),
    ],
    needs=("customer",),
)

APPLICATION_TEST = ViewSpec(
    "application_test", "supplier",
    [("SK_ID_CURR", "20000000 + s_suppkey")],
    needs=("supplier",),
)

BUREAU = ViewSpec(
    "bureau", "orders",
    [
        ("SK_ID_CURR", "CASE WHEN o_custkey % 50 = 3 THEN o_custkey + 10000000 ELSE o_custkey END"),
        ("SK_ID_BUREAU", "o_orderkey"),
        ("CREDIT_ACTIVE", "CASE WHEN o_orderstatus = 'F' THEN 'Closed' WHEN o_orderstatus = 'O' THEN 'Active' "
                          "WHEN o_orderkey % 97 < 10 THEN 'Bad debt' ELSE 'Sold' END"),
        ("CREDIT_CURRENCY", "CASE WHEN o_orderkey % 100 = 1 THEN 'currency 2' "
                            "WHEN o_orderkey % 333 = 2 THEN 'currency 3' ELSE 'currency 1' END"),
        ("DAYS_CREDIT", "-{DAYS}"),
        ("CREDIT_DAY_OVERDUE", "CASE WHEN o_orderkey % 40 = 0 THEN o_orderkey % 90 ELSE 0 END"),
        ("DAYS_CREDIT_ENDDATE", "CASE WHEN o_orderkey % 16 = 4 THEN NULL WHEN o_orderkey % 200 = 11 THEN 31000 "
                                "WHEN o_orderkey % 200 = 13 THEN -19000 WHEN o_orderkey % 250 = 17 THEN -{DAYS} - 10 "
                                "ELSE -{DAYS} + (o_orderkey*53 % 5000) END"),
        ("DAYS_ENDDATE_FACT", "CASE WHEN o_orderkey % 900 = 31 THEN 365243 "
                              "WHEN (o_orderstatus = 'F' AND o_orderkey % 150 <> 0) OR o_orderkey % 300 = 7 "
                              "THEN -{DAYS} + (o_orderkey*29 % 700) END"),
        ("AMT_CREDIT_MAX_OVERDUE", "CASE WHEN o_orderkey % 15 = 0 THEN CAST(o_orderkey*7 % 9000 AS DOUBLE) "
                                   "WHEN o_orderkey % 3 = 0 THEN 0E0 END"),
        ("CNT_CREDIT_PROLONG", "CASE WHEN o_orderkey % 110 = 0 THEN o_orderkey % 7 "
                               "WHEN o_orderkey % 800 = 1 THEN -1 ELSE 0 END"),
        ("AMT_CREDIT_SUM", "CASE WHEN o_orderkey % 25 = 6 THEN 0E0 WHEN o_orderkey % 901 = 2 THEN NULL "
                           "WHEN o_orderkey % 700 = 3 THEN 99999E0 ELSE o_totalprice END"),
        ("AMT_CREDIT_SUM_DEBT", "CASE WHEN o_orderkey % 7 = 3 THEN NULL "
                                "WHEN o_orderkey % 200 = 9 THEN -CAST(o_orderkey % 5000 AS DOUBLE) "
                                "WHEN o_orderkey % 60 = 8 THEN o_totalprice + 1000 "
                                "WHEN o_orderstatus = 'F' AND o_orderkey % 20 <> 1 THEN 0E0 "
                                "ELSE (o_orderkey*7907 % 10000000) / 100E0 END"),
        ("AMT_CREDIT_SUM_LIMIT", "CASE WHEN o_orderkey % 400 = 9 THEN CAST(o_orderkey % 5000 AS DOUBLE) "
                                 "WHEN o_orderkey % 3 = 1 THEN NULL "
                                 "WHEN o_orderkey % 9 = 2 THEN CAST(o_orderkey % 20000 AS DOUBLE) "
                                 "WHEN o_orderkey % 999 = 5 THEN -250E0 ELSE 0E0 END"),
        ("AMT_CREDIT_SUM_OVERDUE", "CASE WHEN o_orderkey % 80 = 0 THEN CAST(o_orderkey % 3000 AS DOUBLE) "
                                   "WHEN o_orderkey % 501 = 4 THEN 75E0 ELSE 0E0 END"),
        ("CREDIT_TYPE", "CASE WHEN o_orderkey % 211 = 4 THEN ' credit Card ' "
                        "WHEN o_orderpriority = '1-URGENT' THEN 'Consumer credit' "
                        "WHEN o_orderpriority = '2-HIGH' THEN 'Credit card' "
                        "WHEN o_orderpriority = '3-MEDIUM' THEN 'Car loan' "
                        "WHEN o_orderpriority = '5-LOW' THEN 'Cash loan (non-earmarked)' ELSE 'Mortgage' END"),
        ("DAYS_CREDIT_UPDATE", "-(o_orderkey*11 % 2900)"),
        ("AMT_ANNUITY", "CASE WHEN o_orderkey % 7 < 5 THEN NULL WHEN o_orderkey % 1000 = 5 THEN 9999E0 "
                        "ELSE CAST(o_orderkey*3 % 50000 AS DOUBLE) END"),
    ],
    needs=("orders",),
)

_BB_CODE = "(l_orderkey*13 + l_linenumber*7) % 100"
BUREAU_BALANCE = ViewSpec(
    "bureau_balance", "lineitem",
    [
        # the months of loans 0-10 of every 20 go to loans 11-18, so that some loans have no history
        ("SK_ID_BUREAU", "CASE WHEN l_orderkey % 20 = 19 THEN l_orderkey + 10000000 "
                         "WHEN l_orderkey % 20 < 11 THEN l_orderkey - l_orderkey % 20 + 11 + (l_orderkey % 20) % 8 "
                         "ELSE l_orderkey END"),
        ("MONTHS_BALANCE", "CAST(-((l_linenumber-1)*14 + l_partkey % 14) AS BIGINT)"),
        ("STATUS", f"CASE WHEN {_BB_CODE} < 50 THEN 'C' WHEN {_BB_CODE} < 73 THEN '0' "
                   f"WHEN {_BB_CODE} < 94 THEN 'X' "
                   f"ELSE CAST({_BB_CODE} % 5 + 1 AS {{CHAR1}}) END"),
    ],
    needs=("lineitem",),
)

_DUE = "-(31 + (l_orderkey*17 + l_linenumber*30) % 2880)"
INSTALLMENTS_PAYMENTS = ViewSpec(
    "installments_payments", "lineitem",
    [
        # customer 5 of every 20 has no payments: the next customer has them
        ("SK_ID_CURR", "CASE WHEN o_custkey % 20 = 5 THEN o_custkey + 1 ELSE o_custkey END"),
        ("SK_ID_PREV", "l_orderkey"),
        ("NUM_INSTALMENT_VERSION", "CAST(l_orderkey % 3 AS DOUBLE)"),
        ("NUM_INSTALMENT_NUMBER", "CAST(l_linenumber AS BIGINT)"),
        ("DAYS_INSTALMENT", f"CAST({_DUE} AS DOUBLE)"),
        ("DAYS_ENTRY_PAYMENT", f"CASE WHEN l_partkey % 400 = 0 THEN NULL "
                               f"ELSE CAST({_DUE} + l_partkey % 41 - 30 AS DOUBLE) END"),
        ("AMT_INSTALMENT", "l_extendedprice"),
        ("AMT_PAYMENT", "CASE WHEN l_partkey % 400 = 0 THEN NULL "
                        "WHEN l_suppkey % 10 = 0 THEN l_extendedprice - 100 "
                        "WHEN l_suppkey % 10 = 1 THEN l_extendedprice / 3 ELSE l_extendedprice END"),
    ],
    join_orders=True,
    needs=("lineitem", "orders"),
)

CREDIT_CARD_BALANCE = ViewSpec(
    "credit_card_balance", "events",
    [
        ("SK_ID_CURR", "user_id"),
        ("SK_ID_PREV", "user_id*10 + event_id % 3"),
        ("MONTHS_BALANCE", "-(1 + event_id % 96)"),
        ("AMT_BALANCE", "CASE WHEN event_id % 211 = 0 THEN NULL WHEN event_id % 97 = 0 THEN -50E0 "
                        "ELSE CAST(event_id*7919 % 20000 AS DOUBLE) END"),
        ("AMT_CREDIT_LIMIT_ACTUAL", "CASE WHEN user_id % 9 = 0 THEN 0 ELSE 5000 + 1000*(user_id % 20) END"),
        ("AMT_INST_MIN_REGULARITY", "CASE WHEN event_id % 12 = 0 THEN NULL ELSE CAST(event_id*31 % 900 AS DOUBLE) END"),
        ("AMT_PAYMENT_CURRENT", "CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(event_id*17 % 1000 AS DOUBLE) END"),
        ("AMT_PAYMENT_TOTAL_CURRENT", "CAST(event_id*17 % 1000 AS DOUBLE)"),
        ("NAME_CONTRACT_STATUS", "CASE WHEN event_type = 'error' THEN 'Completed' ELSE 'Active' END"),
        ("SK_DPD", "CASE WHEN event_id % 25 = 0 THEN event_id % 60 ELSE 0 END"),
        ("SK_DPD_DEF", "CASE WHEN event_id % 50 = 0 THEN event_id % 60 ELSE 0 END"),
    ],
    needs=("events",),
)

POS_CASH_BALANCE = ViewSpec(
    "POS_CASH_balance", "lineitem",
    [
        ("SK_ID_PREV", "l_orderkey"),
        # customer 6 of every 25 has no such loans: the next customer has them
        ("SK_ID_CURR", "CASE WHEN o_custkey % 25 = 6 THEN o_custkey + 1 ELSE o_custkey END"),
        ("MONTHS_BALANCE", "CAST(-(l_linenumber*5 + l_partkey % 5) AS BIGINT)"),
        ("CNT_INSTALMENT", "CASE WHEN l_orderkey % 380 = 0 THEN NULL ELSE CAST(6 + l_orderkey % 30 AS DOUBLE) END"),
        ("CNT_INSTALMENT_FUTURE", "CASE WHEN l_orderkey % 380 = 0 THEN NULL "
                                  "ELSE CAST((l_orderkey + l_linenumber) % 12 AS DOUBLE) END"),
        ("NAME_CONTRACT_STATUS", "CASE WHEN l_orderkey % 19 = 0 THEN ' Completed ' "
                                 "WHEN l_orderkey % 501 = 0 THEN 'Signed' ELSE 'Active' END"),
        ("SK_DPD", "CASE WHEN l_orderkey % 410 = 3 THEN NULL "
                   "WHEN (l_orderkey + l_linenumber) % 30 = 0 THEN l_orderkey % 45 ELSE 0 END"),
        ("SK_DPD_DEF", "CASE WHEN l_orderkey % 410 = 3 THEN NULL "
                       "WHEN (l_orderkey + l_linenumber) % 90 = 0 THEN l_orderkey % 45 ELSE 0 END"),
    ],
    join_orders=True,
    needs=("lineitem", "orders"),
)

PREVIOUS_APPLICATION = ViewSpec(
    "previous_application", "orders",
    [
        ("SK_ID_PREV", "o_orderkey"),
        ("SK_ID_CURR", "o_custkey"),
        ("NAME_CONTRACT_TYPE", "CASE WHEN o_orderkey % 2 = 0 THEN 'Cash loans' ELSE ' Consumer loans' END"),
        ("NAME_CONTRACT_STATUS", "CASE WHEN o_orderstatus = 'F' THEN 'Approved' "
                                 "WHEN o_orderstatus = 'O' THEN 'Refused ' ELSE 'Canceled' END"),
        ("NAME_PAYMENT_TYPE", "'Cash through the bank'"),
        ("CODE_REJECT_REASON", "CASE WHEN o_orderstatus = 'O' THEN 'HC' ELSE 'XAP' END"),
        ("NAME_CLIENT_TYPE", "'Repeater'"),
        ("NAME_PORTFOLIO", "'POS'"),
        ("NAME_PRODUCT_TYPE", "'XNA'"),
        ("PRODUCT_COMBINATION", "'POS household with interest'"),
        ("NAME_YIELD_GROUP", "CASE WHEN o_orderkey % 4 = 0 THEN 'low_normal' ELSE 'Middle' END"),
        ("AMT_ANNUITY", "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE (o_orderkey*31 % 4000000)/100E0 END"),
        ("AMT_APPLICATION", "o_totalprice"),
        ("AMT_CREDIT", "o_totalprice + 500"),
        ("AMT_DOWN_PAYMENT", "CASE WHEN o_orderkey % 2 = 1 THEN NULL ELSE CAST(o_orderkey % 9000 AS DOUBLE) END"),
        ("AMT_GOODS_PRICE", "CASE WHEN o_orderkey % 4 = 1 THEN NULL ELSE o_totalprice END"),
        ("RATE_DOWN_PAYMENT", "CASE WHEN o_orderkey % 2 = 1 THEN NULL ELSE (o_orderkey % 1000)/1000E0 END"),
        ("RATE_INTEREST_PRIMARY", "CASE WHEN o_orderkey % 300 = 0 THEN 0.25E0 END"),
        ("RATE_INTEREST_PRIVILEGED", "CASE WHEN o_orderkey % 300 = 0 THEN 0.75E0 END"),
        ("WEEKDAY_APPR_PROCESS_START", "'MONDAY'"),
        ("HOUR_APPR_PROCESS_START", "o_orderkey % 24"),
        ("DAYS_DECISION", "-{DAYS}"),
        ("DAYS_FIRST_DRAWING", "CASE WHEN o_orderkey % 10 <> 0 THEN 365243E0 ELSE CAST(-{DAYS} + 10 AS DOUBLE) END"),
        ("DAYS_FIRST_DUE", "CASE WHEN o_orderkey % 8 = 0 THEN NULL WHEN o_orderkey % 40 = 1 THEN 365243E0 "
                           "ELSE CAST(-{DAYS} + 30 AS DOUBLE) END"),
        ("DAYS_LAST_DUE_1ST_VERSION", "CASE WHEN o_orderkey % 30 = 2 THEN 365243E0 "
                                      "ELSE CAST(-{DAYS} + 300 AS DOUBLE) END"),
        ("DAYS_LAST_DUE", "CASE WHEN o_orderkey % 5 = 3 THEN 365243E0 ELSE CAST(-{DAYS} + 250 AS DOUBLE) END"),
        ("DAYS_TERMINATION", "CASE WHEN o_orderkey % 5 = 3 THEN 365243E0 ELSE CAST(-{DAYS} + 260 AS DOUBLE) END"),
        ("NAME_TYPE_SUITE", "CASE WHEN o_orderkey % 2 = 0 THEN 'Unaccompanied' END"),
        ("NAME_GOODS_CATEGORY", "'Mobile'"),
        ("CHANNEL_TYPE", "'Country-wide'"),
        ("SELLERPLACE_AREA", "o_orderkey % 2000 - 1"),
        ("NAME_SELLER_INDUSTRY", "'Connectivity'"),
        ("CNT_PAYMENT", "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(6*(1 + o_orderkey % 10) AS DOUBLE) END"),
        ("FLAG_LAST_APPL_PER_CONTRACT", "o_orderkey % 200 <> 0"),
        ("NFLAG_LAST_APPL_IN_DAY", "CASE WHEN o_orderkey % 300 = 0 THEN 0 ELSE 1 END"),
        ("NFLAG_INSURED_ON_APPROVAL", "CASE WHEN o_orderkey % 5 = 0 THEN NULL "
                                      "WHEN o_orderkey % 3 = 0 THEN 1E0 ELSE 0E0 END"),
    ],
    needs=("orders",),
)

VIEWS: dict[str, ViewSpec] = {
    v.name: v
    for v in (
        APPLICATION_TRAIN, APPLICATION_TEST, BUREAU, BUREAU_BALANCE,
        INSTALLMENTS_PAYMENTS, CREDIT_CARD_BALANCE, POS_CASH_BALANCE, PREVIOUS_APPLICATION,
    )
}


def duckdb_view_sql(name: str) -> str:
    """The view as a DuckDB ``SELECT`` over the driver's pre-registered tables."""
    v = VIEWS[name]
    cols = ",\n  ".join(f"{e} AS {n}" for n, e in v.exprs("duckdb"))
    src = v.base + (" JOIN orders ON l_orderkey = o_orderkey" if v.join_orders else "")
    sql = f"SELECT {'DISTINCT ' if v.distinct else ''}\n  {cols}\nFROM {src}"
    if v.where:
        sql += f"\nWHERE {v.where}"
    return sql
