"""Each query with SQL text against DuckDB, and the registration."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerlark.llm import queries


def test_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    assert set(queries.SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = con.execute(queries.SQL[name]).df()
    got = queries.QUERIES[name](spark, sf).toPandas()
    cols = sorted(want.columns)
    key = lambda df: Counter(df[cols].astype(object).where(df[cols].notna(), None).itertuples(index=False, name=None))
    assert sorted(got.columns) == cols and key(got) == key(want)
