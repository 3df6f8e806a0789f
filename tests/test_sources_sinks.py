"""Raw loaders (parquet, CSV with explicit schema), table sinks, clustered sink, streaming staging."""

from __future__ import annotations

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from paths import SF_SMALL
from ledgerlark.operators import staging as st
from ledgerlark.plans.catalog import Catalog
from ledgerlark.plans.sinks import build, write_table
from ledgerlark.sources.raw import load_table, load_tables, rejected_records, write_rejects
from ledgerlark.streaming.incremental import stage_stream


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_raw_parquet_and_csv_round_trip(spark, tmp_path):
    cat = entry.catalog(spark, SF_SMALL)
    for name in ["bureau", "bureau_balance", "application_train"]:
        cat.src[name].write.parquet(str(tmp_path / "pq" / name))
        (cat.src[name].write.option("header", True).option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(str(tmp_path / "csv" / name)))
    pq_tabs = load_tables(spark, str(tmp_path / "pq"), names=("bureau", "bureau_balance", "application_train"))
    for name, df in pq_tabs.items():
        assert _rows(df) == _rows(cat.src[name].select(*df.columns))
    csv_b = load_table(spark, str(tmp_path / "csv"), "bureau", fmt="csv")
    assert dict(csv_b.dtypes)["DAYS_CREDIT"] == "bigint"
    assert _rows(csv_b) == _rows(cat.src["bureau"].select(*csv_b.columns))


def test_clustered_sink_has_disjoint_sorted_files(spark, tmp_path):
    fct = entry.catalog(spark, SF_SMALL).fct_ml_payment_behavior_features
    out = str(tmp_path / "fct")
    write_table(fct, out, cluster_by=["customer_id"], num_files=4)
    files = sorted(p for p in (tmp_path / "fct").glob("part-*.parquet"))
    assert 1 < len(files) <= 4
    ranges = []
    for f in files:
        col = pq.read_table(f, columns=["customer_id"]).column(0).to_pylist()
        assert col == sorted(col)
        ranges.append((col[0], col[-1]))
    ranges.sort()
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert spark.read.parquet(out).count() == fct.count()


def test_build_writes_every_table_model(spark, tmp_path):
    cat = Catalog(entry.catalog(spark, SF_SMALL).src, spark=spark)
    paths = build(cat, str(tmp_path / "build"))
    assert set(paths) >= {"mart_customer_credit_history", "fct_ml_payment_behavior_features"}
    assert spark.read.parquet(paths["int_bureau_enriched"]).count() == cat.stg_bureau.count()


def test_streaming_staging_equals_batch(spark, tmp_path):
    cat = entry.catalog(spark, SF_SMALL)
    raw = cat.src["POS_CASH_balance"]
    src = tmp_path / "landing"
    # raw files land in two drops
    raw.where(F.col("SK_ID_PREV") % 2 == 0).write.parquet(str(src / "drop1"))
    raw.where(F.col("SK_ID_PREV") % 2 == 1).write.parquet(str(src / "drop2"))
    q = stage_stream(spark, "POS_CASH_balance", str(src / "*"), str(tmp_path / "staged"),
                     str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "staged"))
    assert _rows(got) == _rows(st.stg_pos_cash_balance(raw))


def test_streaming_staging_from_csv_keeps_padding(spark, tmp_path):
    cat = entry.catalog(spark, SF_SMALL)
    raw = cat.src["bureau"]
    (raw.write.option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(str(tmp_path / "landing" / "drop1")))
    q = stage_stream(spark, "bureau", str(tmp_path / "landing" / "*"), str(tmp_path / "staged"),
                     str(tmp_path / "ckpt"), fmt="csv")
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "staged"))
    assert _rows(got) == _rows(st.stg_bureau(raw))
    assert got.where(F.col("CREDIT_TYPE") == " credit Card ").count() > 0


def test_raw_columns_are_bound_by_name(spark, tmp_path):
    """Another column order and extra columns, in CSV and parquet; a missing column raises."""
    cat = entry.catalog(spark, SF_SMALL)
    inst, app = cat.src["installments_payments"], cat.src["application_train"]
    shuffled = inst.select(F.lit("x ").alias("EXTRA"), *reversed(inst.columns))
    shuffled.write.option("header", True).option("ignoreTrailingWhiteSpace", False).csv(str(tmp_path / "csv" / "installments_payments"))
    shuffled.write.parquet(str(tmp_path / "pq" / "installments_payments"))
    for fmt in ("csv", "parquet"):
        got = load_table(spark, str(tmp_path / ("csv" if fmt == "csv" else "pq")), "installments_payments", fmt=fmt)
        assert got.columns[-1] == "EXTRA" and got.where("EXTRA <> 'x '").count() == 0
        assert _rows(got.select(*inst.columns)) == _rows(inst)
    inst.drop("SK_ID_PREV").write.option("header", True).csv(str(tmp_path / "bad" / "installments_payments"))
    with pytest.raises(ValueError, match="SK_ID_PREV"):
        load_table(spark, str(tmp_path / "bad"), "installments_payments", fmt="csv")
    app.withColumn("CODE_GENDER", F.lit("F")).write.parquet(str(tmp_path / "pq" / "application_train"))
    more = Catalog(dict(cat.src, application_train=load_table(spark, str(tmp_path / "pq"), "application_train")), spark=spark)
    assert "CODE_GENDER" in more.stg_application_train_clean.columns
    assert "CODE_GENDER" in more.mart_target_kpi_analysis.columns


def test_build_writes_each_table_once(spark, tmp_path):
    cat = Catalog(entry.catalog(spark, SF_SMALL).src, materialize=True, spark=spark)
    out = build(cat, str(tmp_path / "out"))
    assert all(path == f"{tmp_path}/out/{name}" for name, path in out.items())
    assert set(cat.written.values()) <= {f"{tmp_path}/out/{m}" for m in [*out, "bureau_balance_loan_summary"]}


def test_csv_rejects_are_counted_and_good_rows_load(spark, tmp_path, capsys):
    folder = tmp_path / "csv" / "bureau_balance"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("SK_ID_BUREAU,MONTHS_BALANCE,STATUS,NOTE\n1,-1,C,ok\nx,-2,0,bad id\n2,-3,1\n")
    (folder / "b.csv").write_text("SK_ID_BUREAU,MONTHS_BALANCE,STATUS,NOTE\n3,-1, X ,ok\n4,-1,0,too,many\n5,1.5,0,bad month\n,,,\n")
    root = str(tmp_path / "csv")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|CAST_INVALID"):
        load_table(spark, root, "bureau_balance", "csv").collect()
    good = load_table(spark, root, "bureau_balance", "csv", bad_rows="reject")
    assert _rows(good) == _rows(spark.createDataFrame([(1, -1, "C", "ok"), (3, -1, " X ", "ok"), (None, None, None, None)], good.schema))
    # the same rows whatever is selected
    assert good.count() == 3 and sorted(r.STATUS or "" for r in good.select("STATUS").collect()) == ["", " X ", "C"]
    bad = rejected_records(spark, root, "bureau_balance")
    assert {(r.file.rsplit("/", 1)[1], r.record) for r in bad.collect()} == {
        ("a.csv", "x,-2,0,bad id"), ("a.csv", "2,-3,1"), ("b.csv", "4,-1,0,too,many"), ("b.csv", "5,1.5,0,bad month")}
    assert write_rejects(spark, root, ["bureau_balance"], str(tmp_path / "rejects")) == {"bureau_balance": 4}
    assert spark.read.parquet(str(tmp_path / "rejects" / "bureau_balance")).where("table_name = 'bureau_balance'").count() == 4
    with pytest.raises(ValueError, match="bad_rows"):
        load_table(spark, root, "bureau_balance", "csv", bad_rows="ignore")
