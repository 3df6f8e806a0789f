"""Staged writes: a table that breaks its contract is never published."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerlark.__main__ import main
from ledgerlark.plans.catalog import Catalog
from ledgerlark.plans.publish import CONTRACTS, AuditFailed, Contract, audit, audit_published, publish
from ledgerlark.plans.sinks import BUILD_MODELS, build, write_table
from paths import SF_SMALL


class FannedOut(Catalog):
    """The loan summary has two rows per loan, so every join onto it fans out."""

    @property
    def bureau_balance_loan_summary(self):
        once = Catalog.bureau_balance_loan_summary.func(self)
        return once.unionByName(once)

    def _table(self, name, df):  # the summary itself is not what is tested
        return df if name == "bureau_balance_loan_summary" else super()._table(name, df)


def test_every_table_model_has_a_contract():
    assert set(BUILD_MODELS) <= set(CONTRACTS)


def test_audit_counts_what_is_wrong(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "k long, v string")
    assert audit(df, Contract(("k",)), 3) == {"keys in several rows": 2, "rows with a NULL key": 2, "rows more than the 3 expected": 2}
    assert audit(df, Contract(("k", "v"), nulls=True), 9) == {"rows fewer than the 9 expected": 4}
    assert audit(df, Contract(("v",)), 5) == {}
    assert audit(df.limit(0), Contract(("v",)), 0) == {}


def test_fanned_out_table_is_never_published(spark, tmp_path):
    src, out = entry.catalog(spark, SF_SMALL).src, str(tmp_path / "out")
    good = build(Catalog(src, materialize=True, spark=spark), out)
    before = sorted(map(tuple, spark.read.parquet(good["int_bureau_enriched"]).select("SK_ID_BUREAU", "months_of_history").collect()), key=str)
    with pytest.raises(AuditFailed) as failed:
        build(FannedOut(src, materialize=True, spark=spark), out)
    assert failed.value.model == "int_bureau_balance_summarized" or failed.value.model == "int_bureau_enriched"
    with pytest.raises(AuditFailed, match="int_bureau_enriched") as failed:
        cat = FannedOut(src, materialize=True, spark=spark)
        cat.dest = out
        cat.int_bureau_enriched  # noqa: B018
    assert failed.value.findings["keys in several rows"] > 0
    # the last good version is still there, the rejected files are not under its name
    after = sorted(map(tuple, spark.read.parquet(good["int_bureau_enriched"]).select("SK_ID_BUREAU", "months_of_history").collect()), key=str)
    assert after == before and spark.read.parquet(failed.value.path).count() > len(after)
    nowhere = str(tmp_path / "first")
    with pytest.raises(AuditFailed):
        build(FannedOut(src, materialize=True, spark=spark), nowhere)
    assert not (tmp_path / "first" / "int_bureau_enriched").exists()


def test_publish_replaces_and_cleans_up(spark, tmp_path):
    root, one = str(tmp_path), Contract(("k",))
    for n in (3, 5):
        df = spark.range(n).withColumnRenamed("id", "k")
        path = publish(spark, "t", root, lambda to, df=df: write_table(df, to), lambda n=n: n, one)
        assert path == f"{root}/t" and spark.read.parquet(path).count() == n
    assert not list((tmp_path / "_staged").glob("*")) and not list((tmp_path / "_replaced").glob("*"))
    with pytest.raises(AuditFailed, match="fewer"):
        publish(spark, "t", root, lambda to: write_table(spark.range(2).withColumnRenamed("id", "k"), to), lambda: 5, one)
    assert spark.read.parquet(f"{root}/t").count() == 5


def test_check_reads_the_written_tables(spark, tmp_path, capsys):
    src = entry.catalog(spark, SF_SMALL).src
    for name in src:
        src[name].write.parquet(str(tmp_path / "raw" / name))
    raw, built = str(tmp_path / "raw"), str(tmp_path / "built")
    assert main(["check", "--raw", raw, "--built", built]) == 1  # nothing was built
    build(Catalog(src, spark=spark), built)
    capsys.readouterr()
    assert main(["check", "--raw", raw, "--built", built]) == 0
    assert "PASS\tpublished\tint_bureau_enriched\t0" in capsys.readouterr().out
    table = spark.read.parquet(f"{built}/int_bureau_enriched")
    table.limit(1).write.mode("append").parquet(f"{built}/int_bureau_enriched")
    assert main(["check", "--raw", raw, "--built", built]) == 1
    assert "FAIL\tpublished\tint_bureau_enriched\t2\tkeys in several rows" in capsys.readouterr().out
    found = audit_published(spark, built, lambda spine: 0, ["rpt_gelir_dilimleri", "int_bureau_enriched"])
    assert found["rpt_gelir_dilimleri"] == {} and len(found["int_bureau_enriched"]) == 2


def test_clustered_files_follow_bytes_and_spread_a_hot_key(spark, tmp_path):
    """A key with a third of the rows: files of about equal size, key ranges that meet in one key at most."""
    noise = F.sha2(F.col("id").cast("string"), 256).alias("noise")
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 777).otherwise(F.col("id") % 5000).alias("k"), noise).repartition(4)
    write_table(df, str(tmp_path / "t"), cluster_by=["k"], file_bytes=300_000)
    files = list((tmp_path / "t").glob("part-*.parquet"))
    sizes = [f.stat().st_size for f in files]
    assert len(files) >= 6 and max(sizes) <= 2 * min(sizes)
    spans = sorted(tuple(spark.read.parquet(str(f)).agg(F.min("k"), F.max("k")).first()) for f in files)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 60_000
