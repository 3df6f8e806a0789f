"""Every query key on synthetic credit tables where one key holds a third of the rows.

One customer owns a third of the bureau loans, payments, card months and POS
months; one loan owns a third of the monthly bureau history; one income
value and the NULL incomes are a third each.  The same parquet files are
registered in DuckDB and every key's oracle text (sources registered, not
derived) must give the same rows as Spark: brute force on a small fixture.
"""

from __future__ import annotations

import math
import random
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerlark.oracle.sql import sql_for
from ledgerlark.plans.catalog import Catalog
from ledgerlark.plans.registry import KPI06_MIN_COUNT, QUERIES
from ledgerlark.sources.raw import SCHEMAS, load_tables

HOT_CUSTOMER = 1
HOT_LOAN = 5

VOCAB = {
    "CREDIT_ACTIVE": ["Closed", "Active", "Sold", "Bad debt"],
    "CREDIT_CURRENCY": ["currency 1", "currency 1", "currency 1", "currency 2"],
    "CREDIT_TYPE": ["Consumer credit", "Credit card", " credit Card ", "Car loan", "Mortgage"],
    "STATUS": ["C", "C", "0", "X", "1", "2", "3", "4", "5"],
    "OCCUPATION_TYPE": ["Laborers", "Core staff", None],
    "NAME_EDUCATION_TYPE": ["Academic degree", "Higher education", "Incomplete higher", "Lower secondary",
                            "Secondary / secondary special"],
    "NAME_CONTRACT_STATUS": ["Active", " Completed ", "Signed", "Approved", "Refused "],
    "NAME_CONTRACT_TYPE": ["Cash loans", " Consumer loans"],
}


def _value(rnd: random.Random, name: str, dtype: str, i: int):
    if name in VOCAB:
        return rnd.choice(VOCAB[name])
    if rnd.random() < 0.08 and name not in ("SK_ID_CURR", "SK_ID_BUREAU", "SK_ID_PREV", "TARGET"):
        return None
    if dtype == "bigint":
        if name.startswith("DAYS") or name == "MONTHS_BALANCE":
            return -rnd.randint(0, 3000) if name != "MONTHS_BALANCE" else -rnd.randint(0, 96)
        return rnd.randint(-1, 60)
    if dtype == "double":
        if name.startswith("AMT"):
            return round(rnd.uniform(-500, 50000), 2)
        if name.startswith("DAYS"):
            return float(rnd.choice([365243, -rnd.randint(0, 3000)]))
        return round(rnd.uniform(0, 30), 1)
    if dtype == "boolean":
        return rnd.random() < 0.5
    return rnd.choice(["A", "b", " c "])


def _table(spark, name: str, n: int, rnd: random.Random, fixed):
    schema = SCHEMAS[name]
    rows = []
    for i in range(n):
        row = {f.name: _value(rnd, f.name, f.dataType.simpleString(), i) for f in schema.fields}
        row.update(fixed(i))
        rows.append(tuple(row[f.name] for f in schema.fields))
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    rnd = random.Random(7)
    root = tmp_path_factory.mktemp("skewed")
    n_cust = 300

    def cust(i):  # a third of all rows belong to one customer
        return HOT_CUSTOMER if i % 3 == 0 else 2 + (i % n_cust)

    tables = {
        "application_train": _table(spark, "application_train", n_cust, rnd, lambda i: {
            "SK_ID_CURR": i + 1, "TARGET": int(i % 7 == 0),
            "AMT_INCOME_TOTAL": None if i % 3 == 1 else (135000.0 if i % 3 == 0 else 20000.0 + 997 * i),
            "AMT_CREDIT": 45000.0 + 1350 * (i % 400), "DAYS_BIRTH": -(7500 + 53 * i)}),
        "application_test": _table(spark, "application_test", 50, rnd, lambda i: {"SK_ID_CURR": 20000 + i}),
        "bureau": _table(spark, "bureau", 3000, rnd, lambda i: {"SK_ID_BUREAU": i, "SK_ID_CURR": cust(i)}),
        "bureau_balance": _table(spark, "bureau_balance", 6000, rnd, lambda i: {
            "SK_ID_BUREAU": HOT_LOAN if i % 3 == 0 else i % 4000, "MONTHS_BALANCE": -(i // 3) % 97 - (i % 3)}),
        "installments_payments": _table(spark, "installments_payments", 6000, rnd, lambda i: {
            "SK_ID_CURR": cust(i), "SK_ID_PREV": i % 900, "NUM_INSTALMENT_NUMBER": i % 12,
            "NUM_INSTALMENT_VERSION": float(i % 2), "DAYS_INSTALMENT": float(-(i % 2000)),
            "DAYS_ENTRY_PAYMENT": float(-(i % 2000) + (i % 41) - 30) if i % 50 else None}),
        "credit_card_balance": _table(spark, "credit_card_balance", 3000, rnd, lambda i: {
            "SK_ID_CURR": cust(i), "SK_ID_PREV": i % 500, "AMT_CREDIT_LIMIT_ACTUAL": 0 if i % 9 == 0 else 9000,
            "MONTHS_BALANCE": -(i % 40)}),
        "POS_CASH_balance": _table(spark, "POS_CASH_balance", 3000, rnd, lambda i: {
            "SK_ID_CURR": cust(i), "SK_ID_PREV": i % 700, "MONTHS_BALANCE": -(i % 30)}),
        "previous_application": _table(spark, "previous_application", 1000, rnd, lambda i: {
            "SK_ID_PREV": i, "SK_ID_CURR": cust(i)}),
    }
    for name, df in tables.items():
        df.write.parquet(str(root / name))
    con = duckdb.connect()
    for name in tables:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{root / name}/*.parquet')")
    return Catalog(load_tables(spark, str(root)), spark=spark), con


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i].lower())

    def norm(v):
        if isinstance(v, Decimal):
            v = float(v)
        if isinstance(v, float) and not math.isnan(v) and v != 0:
            return float(f"{v:.9g}")
        return v

    return sorted(tuple(repr(norm(r[i])) for i in order) for r in rows)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_key_on_skewed_tables(skewed, key):
    cat, con = skewed
    df = QUERIES[key](cat)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(sql_for(key, sources_registered=True, kpi06_min_count=KPI06_MIN_COUNT))
    drows, dcols = res.fetchall(), [d[0] for d in res.description]
    assert sorted(c.lower() for c in df.columns) == sorted(c.lower() for c in dcols)
    assert _canon(srows, df.columns) == _canon(drows, dcols)


def test_hot_customer_is_really_hot(skewed):
    cat, _ = skewed
    b = cat.src["bureau"]
    assert b.where(f"SK_ID_CURR = {HOT_CUSTOMER}").count() * 3 >= b.count()
