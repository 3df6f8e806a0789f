
from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from paths import SF_SMALL


@pytest.fixture(scope="module")
def cat(spark):
    return entry.catalog(spark, SF_SMALL)


STAGING = {
    "stg_application_train": "application_train", "stg_application_train_clean": "application_train",
    "stg_bureau": "bureau", "stg_bureau_balance": "bureau_balance",
    "stg_credit_card_balance": "credit_card_balance", "stg_installments_payments": "installments_payments",
    "stg_pos_cash_balance": "POS_CASH_balance", "stg_previous_application": "previous_application",
}


@pytest.mark.parametrize("model,raw", sorted(STAGING.items()))
def test_staging_keeps_row_count(cat, model, raw):
    assert getattr(cat, model).count() == cat.src[raw].count()


def test_left_joins_keep_unique_keys(cat):
    enriched = cat.int_bureau_enriched
    assert enriched.count() == cat.stg_bureau.count() == enriched.select("SK_ID_BUREAU").distinct().count()
    mart = cat.mart_target_kpi_analysis
    assert mart.count() == cat.src["application_train"].count() == mart.select("SK_ID_CURR").distinct().count()
    fct = cat.fct_ml_payment_behavior_features
    assert fct.count() == cat.src["application_train"].count()


def test_history_split_adds_up(cat):
    e = cat.int_bureau_enriched
    with_h = e.where("has_monthly_history").count()
    without = e.where("NOT has_monthly_history").count()
    assert with_h + without == e.count()
    assert with_h == cat.int_bureau_balance_summarized.join(
        cat.stg_bureau.select("SK_ID_BUREAU"), "SK_ID_BUREAU").count()


def test_instalment_outcomes_add_up(cat):
    r = cat.int_installments_customer_features.agg(
        F.sum("TOPLAM_TAKSIT_SAYISI").alias("n"), F.sum("GEC_ODEME_SAYISI").alias("late"),
        F.sum("ZAMANINDA_ODEME_SAYISI").alias("on_time"), F.sum("ERKEN_ODEME_SAYISI").alias("early")).first()
    nulls = cat.int_installments_features.where(F.col("GECIKME_GUNU").isNull()).count()
    assert r.late + r.on_time + r.early + nulls == r.n


def test_band_counts_sum_to_total(cat):
    from ledgerlark.operators import reports as rp
    total = cat.src["application_train"].count()
    for df, col in [(cat.rpt_kredi_gelir_orani(), "musteri_sayisi"), (cat.rpt_yas_egitim_capraz(), "musteri_sayisi"),
                    (cat.rpt_gelir_dilimleri(), "musteri_sayisi"),
                    (rp.kpi_02_default_by_income_band(cat.int_application_train_features), "n")]:
        assert df.agg(F.sum(col)).first()[0] == total


def test_no_null_ml_features(cat):
    fct = cat.fct_ml_payment_behavior_features
    nulls = fct.select([F.count_if(F.col(c).isNull()).alias(c) for c in fct.columns if c != "customer_id"]).first()
    assert all(v == 0 for v in nulls.asDict().values())


def test_materialised_catalog_matches_lazy(spark, cat, tmp_path):
    from ledgerlark.plans.catalog import Catalog
    mat = Catalog(cat.src, materialize=True, spark=spark)
    a = sorted(tuple(r) for r in cat.mart_customer_credit_history.collect())
    b = sorted(tuple(r) for r in mat.mart_customer_credit_history.collect())
    assert a == b


def test_numeric_key_paths_equal_string_key_paths(cat):
    """Grouping by the numeric id and casting once equals grouping by the string id (injective cast)."""
    from ledgerlark.operators import features as ft
    a = sorted(tuple(r) for r in ft.int_pos_cash_kpis(cat.stg_pos_cash_balance).collect())
    b = sorted(tuple(r) for r in ft.int_pos_cash_kpis_from_raw(cat.src["POS_CASH_balance"]).collect())
    assert a == b
