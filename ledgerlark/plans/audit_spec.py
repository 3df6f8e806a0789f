"""Column lists of the bureau audit statements and target summaries (shared by the
Spark registry and the oracle text).

Fixed values: output names and source columns as the reference writes them.
"""

NULL_PCT_COLS = [
    ("pct_null_sk_id_curr", "SK_ID_CURR"), ("pct_null_sk_id_bureau", "SK_ID_BUREAU"),
    ("pct_null_credit_active", "CREDIT_ACTIVE"), ("pct_null_currency", "CREDIT_CURRENCY"),
    ("pct_null_days_credit", "DAYS_CREDIT"), ("pct_null_day_overdue", "CREDIT_DAY_OVERDUE"),
    ("pct_null_credit_enddate", "DAYS_CREDIT_ENDDATE"), ("pct_null_enddate_fact", "DAYS_ENDDATE_FACT"),
    ("pct_null_max_overdue", "AMT_CREDIT_MAX_OVERDUE"), ("pct_null_prolong", "CNT_CREDIT_PROLONG"),
    ("pct_null_credit_sum", "AMT_CREDIT_SUM"), ("pct_null_debt", "AMT_CREDIT_SUM_DEBT"),
    ("pct_null_limit", "AMT_CREDIT_SUM_LIMIT"), ("pct_null_overdue", "AMT_CREDIT_SUM_OVERDUE"),
    ("pct_null_credit_type", "CREDIT_TYPE"), ("pct_null_days_update", "DAYS_CREDIT_UPDATE"),
    ("pct_null_annuity", "AMT_ANNUITY"),
]

PROFILE_COLS = [
    "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM_LIMIT", "AMT_CREDIT_SUM_OVERDUE",
    "AMT_CREDIT_MAX_OVERDUE", "AMT_ANNUITY", "DAYS_CREDIT", "DAYS_CREDIT_ENDDATE", "DAYS_ENDDATE_FACT",
    "DAYS_CREDIT_UPDATE", "CREDIT_DAY_OVERDUE", "CNT_CREDIT_PROLONG",
]

CATEGORY_COLS = ["CREDIT_ACTIVE", "CREDIT_CURRENCY", "CREDIT_TYPE"]

CARD_TARGET = [
    ("ORT_KART_GECIKMELI_AY_ORANI", "KART_GECIKMELI_AY_ORANI"),
    ("ORT_KART_TOLERANS_SONRASI_GECIKME_ORANI", "KART_TOLERANS_SONRASI_GECIKME_ORANI"),
    ("ORT_KART_MAKS_GECIKME_GUNU", "KART_MAKS_GECIKME_GUNU"),
    ("ORT_KART_BORC_BAKIYESI", "KART_ORT_BORC_BAKIYESI"),
    ("ORT_KART_MAKS_BORC_BAKIYESI", "KART_MAKS_BORC_BAKIYESI"),
    ("ORT_KART_LIMIT_KULLANIM_ORANI", "KART_ORT_LIMIT_KULLANIM_ORANI"),
    ("ORT_KART_LIMIT_ASIMLI_AY_ORANI", "KART_LIMIT_ASIMLI_AY_ORANI"),
]

INST_TARGET = [
    ("ORT_TOPLAM_TAKSIT_SAYISI", "TOPLAM_TAKSIT_SAYISI"),
    ("ORT_ESKI_KREDI_SAYISI", "ESKI_KREDI_SAYISI"),
    ("ORT_GEC_ODEME_SAYISI", "GEC_ODEME_SAYISI"),
    ("ORT_ZAMANINDA_ODEME_SAYISI", "ZAMANINDA_ODEME_SAYISI"),
    ("ORT_ERKEN_ODEME_SAYISI", "ERKEN_ODEME_SAYISI"),
    ("ORT_EKSIK_ODEME_SAYISI", "EKSIK_ODEME_SAYISI"),
    ("ORT_TAKSIT_GEC_ODEME_ORANI", "TAKSIT_GEC_ODEME_ORANI"),
    ("ORT_TAKSIT_EKSIK_ODEME_ORANI", "TAKSIT_EKSIK_ODEME_ORANI"),
    ("ORT_TAKSIT_GECIKME_GUNU", "TAKSIT_ORT_GECIKME_GUNU"),
    ("ORT_TAKSIT_MAKS_GECIKME_GUNU", "TAKSIT_MAKS_GECIKME_GUNU"),
]
