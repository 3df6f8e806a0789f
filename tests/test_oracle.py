"""Every registered query equals its DuckDB oracle (row count, names, values).

Runs at sf0.001 to stay quick; ``tools/compare_oracle.py`` runs the same
comparison at sf0.01, the driver's scale.
"""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from paths import SF_SMALL
from ledgerlark.plans.registry import QUERIES

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["customer", "supplier", "orders", "lineitem", "events"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i].lower())

    def norm(v):
        if isinstance(v, Decimal):
            v = float(v)
        if isinstance(v, float) and not math.isnan(v) and v != 0:
            return float(f"{v:.9g}")
        return v

    return sorted(tuple(repr(norm(r[i])) for i in order) for r in rows)


def test_every_key_has_oracle_text():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF_SMALL)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    res = con.execute(entry.oracle_sql()[key])
    drows, dcols = res.fetchall(), [d[0] for d in res.description]
    assert sorted(c.lower() for c in scols) == sorted(c.lower() for c in dcols)
    assert len(srows) == len(drows)
    assert _canon(srows, scols) == _canon(drows, dcols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "total_bureau_loans" in df.columns
