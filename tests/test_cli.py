"""``python -m ledgerlark``: build, check and query over raw parquet tables."""

from __future__ import annotations

import __spark_entry__ as entry
from paths import SF_SMALL
from ledgerlark.__main__ import main


def test_cli_check_build_query(spark, tmp_path, capsys):
    src = entry.catalog(spark, SF_SMALL).src
    raw = tmp_path / "raw"
    for name in src:
        src[name].write.parquet(str(raw / name))
    rc = main(["check", "--raw", str(raw)])
    out = capsys.readouterr().out
    # negative debts are in the raw table on purpose; the range check sees them cleaned
    assert rc == 0
    assert "PASS\tcheck_accepted_range\tbureau.AMT_CREDIT_SUM_DEBT\t0" in out
    assert "PASS\tcheck_unique\tbureau.SK_ID_BUREAU\t0" in out
    assert "PASS\tcheck_join_preserves_rows\tint_bureau_enriched.SK_ID_BUREAU\t0" in out
    src["bureau"].unionByName(src["bureau"]).write.mode("overwrite").parquet(str(raw / "bureau"))
    assert main(["check", "--raw", str(raw)]) == 1
    assert "FAIL\tcheck_unique\tbureau.SK_ID_BUREAU" in capsys.readouterr().out
    src["bureau"].write.mode("overwrite").parquet(str(raw / "bureau"))
    assert main(["build", "--raw", str(raw), "--out", str(tmp_path / "build")]) == 0
    assert spark.read.parquet(str(tmp_path / "build" / "mart_customer_credit_history")).count() > 0
    assert main(["query", "kpi_01_default_rate", "--raw", str(raw), "--out", str(tmp_path / "q")]) == 0
    assert spark.read.parquet(str(tmp_path / "q" / "kpi_01_default_rate")).count() == 1


def test_scale_settings():
    from ledgerlark.session import scale_settings
    small = scale_settings(10 * 1024 * 1024)
    assert small["spark.sql.shuffle.partitions"] == "200"
    huge = scale_settings(100 * 1024 ** 4)  # 100 TB
    assert huge["spark.sql.shuffle.partitions"] == "409600"  # x 256 MB, however large
    assert scale_settings(1024 ** 4)["spark.sql.shuffle.partitions"] == "4096"  # 1 TB / 256 MB
    assert huge["spark.sql.adaptive.enabled"] == "true"


def test_input_bytes(spark, tmp_path):
    from ledgerlark.session import input_bytes
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    assert input_bytes(spark, [str(tmp_path / "t"), str(tmp_path / "missing")]) > 0
