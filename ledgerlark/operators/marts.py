"""Marts: the per-customer credit history, the target/KPI mart and the ML feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.compat import count_if, greatest_nullprop, money_sum, safe_div
from .categories import distinct_category

HOME_CURRENCY = "currency 1"  # Fixed value: the only currency money totals are summed in.


def mart_customer_credit_history(enriched: DataFrame) -> DataFrame:
    """Per customer; money totals only in the home currency (Q2), debt floored at 0 (T1)."""
    home = F.col("CREDIT_CURRENCY") == HOME_CURRENCY
    debt_pos = F.when(home, greatest_nullprop("AMT_CREDIT_SUM_DEBT", 0))
    credit = F.when(home, F.col("AMT_CREDIT_SUM"))
    n = F.count(F.lit(1))
    has_hist = count_if(F.col("has_monthly_history"))
    coded, credit_types = distinct_category(enriched, "CREDIT_TYPE")
    return coded.groupBy("SK_ID_CURR").agg(
        n.alias("total_bureau_loans"),
        count_if(F.col("CREDIT_ACTIVE") == "Active").alias("active_loans"),
        count_if(F.col("CREDIT_ACTIVE") == "Closed").alias("closed_loans"),
        count_if(F.col("CREDIT_ACTIVE") == "Bad debt").alias("bad_debt_loans"),
        credit_types.alias("distinct_credit_types"),
        (F.lit(-1) * F.max("DAYS_CREDIT")).alias("days_since_newest_loan"),
        (F.lit(-1) * F.min("DAYS_CREDIT")).alias("days_since_oldest_loan"),
        count_if(F.col("DAYS_CREDIT") >= -365).alias("loans_opened_last_year"),
        money_sum(credit).alias("total_credit_amount"),
        money_sum(debt_pos).alias("total_current_debt"),
        money_sum(F.when(home, F.col("AMT_CREDIT_SUM_OVERDUE"))).alias("total_overdue_amount"),
        F.max(F.when(home, F.col("AMT_CREDIT_MAX_OVERDUE"))).alias("worst_overdue_ever"),
        F.round(safe_div(money_sum(debt_pos), money_sum(credit)), 4).alias("debt_to_credit_ratio"),
        F.max("worst_dpd_bucket").alias("worst_dpd_bucket_ever"),
        F.sum("months_late_count").alias("total_late_months"),
        F.min("months_since_last_late").alias("months_since_last_late"),
        count_if(F.col("CREDIT_DAY_OVERDUE") > 0).alias("loans_currently_overdue"),
        has_hist.alias("loans_with_history"),
        F.round(safe_div(has_hist, n), 4).alias("share_loans_with_history"),
        count_if(F.col("CREDIT_CURRENCY") != HOME_CURRENCY).alias("foreign_currency_loans"),
        count_if(F.col("AMT_CREDIT_SUM_DEBT") < 0).alias("loans_with_negative_debt"),
    )


# Fixed values: (output name, source column) of the two KPI sets attached to each application.
INSTALMENT_KPI_COLUMNS = [
    ("TOPLAM_TAKSIT_SAYISI", "TOPLAM_TAKSIT_SAYISI"),
    ("ESKI_KREDI_SAYISI", "ESKI_KREDI_SAYISI"),
    ("GEC_ODEME_SAYISI", "GEC_ODEME_SAYISI"),
    ("ZAMANINDA_ODEME_SAYISI", "ZAMANINDA_ODEME_SAYISI"),
    ("ERKEN_ODEME_SAYISI", "ERKEN_ODEME_SAYISI"),
    ("EKSIK_ODEME_SAYISI", "EKSIK_ODEME_SAYISI"),
    ("TAKSIT_GEC_ODEME_ORANI", "GEC_ODEME_ORANI"),
    ("TAKSIT_EKSIK_ODEME_ORANI", "EKSIK_ODEME_ORANI"),
    ("TAKSIT_ORT_GECIKME_GUNU", "ORTALAMA_GECIKME_GUNU"),
    ("TAKSIT_MAKS_GECIKME_GUNU", "MAKS_GECIKME_GUNU"),
]
CARD_KPI_COLUMNS = [
    ("KART_AYLIK_KAYIT_SAYISI", "AYLIK_KAYIT_SAYISI"),
    ("KART_GECIKMELI_AY_SAYISI", "GECIKMELI_AY_SAYISI"),
    ("KART_GECIKMELI_AY_ORANI", "GECIKMELI_AY_ORANI"),
    ("KART_TOLERANS_SONRASI_GECIKMELI_AY_SAYISI", "TOLERANS_SONRASI_GECIKMELI_AY_SAYISI"),
    ("KART_TOLERANS_SONRASI_GECIKME_ORANI", "TOLERANS_SONRASI_GECIKME_ORANI"),
    ("KART_MAKS_GECIKME_GUNU", "MAKS_GECIKME_GUNU"),
    ("KART_ORT_BORC_BAKIYESI", "ORTALAMA_BORC_BAKIYESI"),
    ("KART_MAKS_BORC_BAKIYESI", "MAKS_BORC_BAKIYESI"),
    ("KART_ORT_LIMIT_KULLANIM_ORANI", "ORTALAMA_LIMIT_KULLANIM_ORANI"),
    ("KART_LIMIT_ASIMLI_AY_ORANI", "LIMIT_ASIMLI_AY_ORANI"),
]


def _keyed(df: DataFrame, prefix: str, cols: list[tuple[str, str]]) -> DataFrame:
    return df.select(F.col("SK_ID_CURR").alias(f"{prefix}_key"), *[F.col(s).alias(o) for o, s in cols])


def mart_target_kpi_analysis(app_features: DataFrame, inst_customer: DataFrame,
                             card_features: DataFrame) -> DataFrame:
    """Every application with its instalment and card KPIs; NULL where no history."""
    inst = _keyed(inst_customer, "_i", INSTALMENT_KPI_COLUMNS)
    card = _keyed(card_features, "_c", CARD_KPI_COLUMNS)
    out = (app_features
           .join(inst, app_features["SK_ID_CURR"] == inst["_i_key"], "left")
           .join(card, app_features["SK_ID_CURR"] == card["_c_key"], "left"))
    return out.select(
        *[app_features[c] for c in app_features.columns],
        *[o for o, _ in INSTALMENT_KPI_COLUMNS],
        *[o for o, _ in CARD_KPI_COLUMNS],
    )


# Fixed values: (output name, source column, value when the customer has no history) -- Q9.
ML_FEATURES = {
    "inst": [
        ("inst_avg_payment_delay_days", "avg_payment_delay_days", 0),
        ("inst_max_payment_delay_days", "max_payment_delay_days", 0),
        ("inst_late_payment_ratio", "late_payment_ratio", 0),
        ("inst_underpayment_ratio", "underpayment_ratio", 0),
        ("inst_payment_completion_rate", "payment_completion_rate", 1.0),
        ("inst_recent_payment_delay_trend", "recent_payment_delay_trend", 0),
        ("inst_total_installment_count", "total_installment_count", 0),
    ],
    "cc": [
        ("cc_avg_limit_utilization", "avg_cc_limit_utilization", 0),
        ("cc_max_limit_utilization", "max_cc_limit_utilization", 0),
        ("cc_min_payment_deficit_ratio", "cc_min_payment_deficit_ratio", 0),
        ("cc_max_dpd_last_12m", "max_cc_sk_dpd_last_12m", 0),
        ("cc_total_card_count", "total_cc_card_count", 0),
    ],
    "pos": [
        ("pos_max_dpd_all_time", "max_pos_dpd_all_time", 0),
        ("pos_max_dpd_tolerance_all_time", "max_pos_dpd_tolerance_all_time", 0),
        ("pos_avg_dpd_all_time", "avg_pos_dpd_all_time", 0),
        ("pos_dpd_month_ratio", "pos_dpd_month_ratio", 0),
        ("pos_max_dpd_last_12m", "max_pos_dpd_last_12m", 0),
        ("pos_completed_contracts_ratio", "pos_completed_contracts_ratio", 0),
        ("pos_avg_remaining_instalments", "avg_pos_remaining_instalments", 0),
        ("pos_total_loan_count", "total_pos_loan_count", 0),
    ],
    "bur": [
        ("bureau_active_overdue_amt", "bureau_active_overdue_amt", 0),
        ("bureau_max_overdue_amt", "bureau_max_overdue_amt", 0),
        ("bureau_total_credit_prolong_count", "total_credit_prolong_count", 0),
        ("bureau_dpd_worst_status_count", "bureau_dpd_worst_status_count", 0),
    ],
}


def fct_ml_payment_behavior_features(app_stg: DataFrame, inst_kpis: DataFrame, cc_kpis: DataFrame,
                                     pos_kpis: DataFrame, bureau_kpis: DataFrame) -> DataFrame:
    """One row per applicant, no NULL features.

    The KPI inputs are the ``*_by_customer`` frames (numeric ``SK_ID_CURR``).
    Each is already hash-partitioned on that key by its own aggregate, so the
    four left joins shuffle only the applicant spine, once.
    """
    out = app_stg.select(F.col("sk_id_curr").alias("_app_key"), "target")
    sides = {"inst": inst_kpis, "cc": cc_kpis, "pos": pos_kpis, "bur": bureau_kpis}
    for prefix, side in sides.items():
        keyed = side.select(F.col("SK_ID_CURR").alias(f"_{prefix}_key"),
                            *[F.col(s).alias(f"_{prefix}_{s}") for _, s, _ in ML_FEATURES[prefix]])
        out = out.join(keyed, out["_app_key"] == keyed[f"_{prefix}_key"], "left")
    feats = [
        F.coalesce(F.col(f"_{prefix}_{s}"), F.lit(default)).alias(o)
        for prefix in sides
        for o, s, default in ML_FEATURES[prefix]
    ]
    return out.select(F.col("_app_key").cast("string").alias("customer_id"), "target", *feats)
