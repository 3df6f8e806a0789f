"""Intermediate models: per-loan summaries and per-customer KPI sets.

Design notes for scale:

* Every roll-up is one ``groupBy().agg()``; Spark plans it as a partial
  (map-side) aggregate, an exchange on the key and a final aggregate, so a
  customer or loan holding a third of all rows still ships one partial row
  per map task, never its raw rows.
* The customer-level KPI sets are keyed by ``CAST(SK_ID_CURR AS STRING)`` in
  the reference.  The cast of a 64-bit id is injective, so grouping by the
  numeric id is the same grouping; we group by the number (cheaper hashing,
  cheaper joins) and cast once per customer at the end.  ``*_by_customer``
  functions keep the numeric key for joins; the public functions expose the
  reference's ``customer_id`` string.
* ``bureau_balance_loan_summary`` is the single pass over the 27M-row monthly
  table: both the loan summary and the severe-month count of the bureau KPIs
  come out of it (the reference scans it twice).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.compat import (
    band,
    count_if,
    exact_avg,
    greatest_nullprop,
    money_sum,
    safe_bigint,
    safe_div,
)

# The monthly STATUS codes of the bureau balance table.
LATE_CODES = ["1", "2", "3", "4", "5"]
ON_TIME_CODES = ["0", "C"]
SEVERE_CODES = ["3", "4", "5"]

# Income bands of the application features.
INCOME_EDGES = [100000, 200000, 300000]
INCOME_LABELS = ["<100k", "100-200k", "200-300k", "300k+"]


def int_application_train_features(app_clean: DataFrame) -> DataFrame:
    return app_clean.select(
        "*",
        F.floor(-F.col("DAYS_BIRTH") / F.lit(365.25)).cast("bigint").alias("age_years"),
        band("AMT_INCOME_TOTAL", INCOME_EDGES, INCOME_LABELS).alias("income_band"),
        safe_div("AMT_ANNUITY", "AMT_CREDIT").alias("annuity_to_credit_ratio"),
    )


# --------------------------------------------------------------------------- bureau

def bureau_balance_loan_summary(balance: DataFrame) -> DataFrame:
    """One row per loan from the monthly history: every per-loan metric any model needs."""
    status = F.col("STATUS")
    months_ago = -F.col("MONTHS_BALANCE")
    dpd_bucket = safe_bigint(status)
    was_late = F.when(status.isin(LATE_CODES), F.lit(True)).when(status.isin(ON_TIME_CODES), F.lit(False))
    return balance.groupBy("SK_ID_BUREAU").agg(
        F.count(F.lit(1)).alias("months_of_history"),
        F.max(months_ago).alias("oldest_month_observed"),
        F.min(months_ago).alias("newest_month_observed"),
        F.max(dpd_bucket).alias("worst_dpd_bucket"),
        count_if(was_late).alias("months_late_count"),
        count_if(dpd_bucket == 5).alias("months_written_off_count"),
        F.round(safe_div(count_if(was_late), count_if(was_late.isNotNull())), 4).alias("share_of_months_late"),
        F.min(F.when(was_late, months_ago)).alias("months_since_last_late"),
        count_if(status == "C").alias("months_closed_count"),
        count_if(status == "X").alias("months_unknown_count"),
        F.round(safe_div(count_if(status == "X"), F.count(F.lit(1))), 4).alias("share_of_months_unknown"),
        count_if(status.isin(SEVERE_CODES)).alias("severe_overdue_month_count"),
    )


SUMMARY_COLUMNS = [
    "SK_ID_BUREAU", "months_of_history", "oldest_month_observed", "newest_month_observed",
    "worst_dpd_bucket", "months_late_count", "months_written_off_count", "share_of_months_late",
    "months_since_last_late", "months_closed_count", "months_unknown_count", "share_of_months_unknown",
]


def int_bureau_balance_summarized(balance: DataFrame, summary: DataFrame | None = None) -> DataFrame:
    summary = summary if summary is not None else bureau_balance_loan_summary(balance)
    return summary.select(*SUMMARY_COLUMNS)


ENRICH_COLUMNS = [
    "months_of_history", "worst_dpd_bucket", "months_late_count", "months_written_off_count",
    "share_of_months_late", "months_since_last_late", "months_closed_count", "share_of_months_unknown",
]


def int_bureau_enriched(bureau_stg: DataFrame, summary: DataFrame) -> DataFrame:
    """Left join keeps every loan; the summary is unique per loan, so no fan-out.

    The summary arrives hash-partitioned by SK_ID_BUREAU from its aggregate,
    so only the bureau side is shuffled for the join.
    """
    hist = summary.select(
        F.col("SK_ID_BUREAU").alias("_h_key"), *ENRICH_COLUMNS, F.lit(True).alias("_h_hit"))
    joined = bureau_stg.join(hist, bureau_stg["SK_ID_BUREAU"] == hist["_h_key"], "left")
    return joined.select(
        *[bureau_stg[c] for c in bureau_stg.columns],
        *ENRICH_COLUMNS,
        F.col("_h_hit").isNotNull().alias("has_monthly_history"),
    )


def bureau_kpis_by_customer(bureau_stg: DataFrame, summary: DataFrame) -> DataFrame:
    severe = summary.select(F.col("SK_ID_BUREAU").alias("_s_key"), "severe_overdue_month_count")
    joined = bureau_stg.join(severe, bureau_stg["SK_ID_BUREAU"] == severe["_s_key"], "left")
    active = F.lower(F.col("CREDIT_ACTIVE")) == "active"
    return joined.groupBy("SK_ID_CURR").agg(
        money_sum(F.when(active, F.col("AMT_CREDIT_SUM_OVERDUE")).otherwise(F.lit(0.0)))
        .alias("bureau_active_overdue_amt"),
        F.max("AMT_CREDIT_MAX_OVERDUE").alias("bureau_max_overdue_amt"),
        F.sum("CNT_CREDIT_PROLONG").alias("total_credit_prolong_count"),
        F.sum(F.coalesce(F.col("severe_overdue_month_count"), F.lit(0))).alias("bureau_dpd_worst_status_count"),
    )


def _as_customer_id(df: DataFrame) -> DataFrame:
    """Swap the numeric key for the reference's string ``customer_id`` (first column)."""
    rest = [c for c in df.columns if c != "SK_ID_CURR"]
    return df.select(F.col("SK_ID_CURR").cast("string").alias("customer_id"), *rest)


def int_bureau_kpis(bureau_stg: DataFrame, summary: DataFrame) -> DataFrame:
    return _as_customer_id(bureau_kpis_by_customer(bureau_stg, summary))


# --------------------------------------------------------------------------- cards

def int_credit_card_features(card: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    late = count_if(F.col("SK_DPD") > 0)
    late_tol = count_if(F.col("SK_DPD_DEF") > 0)
    limit = F.col("AMT_CREDIT_LIMIT_ACTUAL")
    bal = F.col("AMT_BALANCE")
    return card.groupBy("SK_ID_CURR").agg(
        n.alias("AYLIK_KAYIT_SAYISI"),
        late.alias("GECIKMELI_AY_SAYISI"),
        F.round(safe_div(late, n) * 100, 2).alias("GECIKMELI_AY_ORANI"),
        late_tol.alias("TOLERANS_SONRASI_GECIKMELI_AY_SAYISI"),
        F.round(safe_div(late_tol, n) * 100, 2).alias("TOLERANS_SONRASI_GECIKME_ORANI"),
        F.max("SK_DPD").alias("MAKS_GECIKME_GUNU"),
        exact_avg(bal).alias("ORTALAMA_BORC_BAKIYESI"),
        F.max(bal).alias("MAKS_BORC_BAKIYESI"),
        F.round(exact_avg(safe_div(bal, F.nullif(limit, F.lit(0)))) * 100, 2).alias("ORTALAMA_LIMIT_KULLANIM_ORANI"),
        F.round(safe_div(count_if((limit > 0) & (bal > limit)), count_if(limit > 0)) * 100, 2)
        .alias("LIMIT_ASIMLI_AY_ORANI"),
    )


def credit_card_kpis_by_customer(card: DataFrame) -> DataFrame:
    deficit = F.when(F.col("AMT_PAYMENT_CURRENT") < F.col("AMT_INST_MIN_REGULARITY"), 1).otherwise(0)
    utilization = safe_div(greatest_nullprop("AMT_BALANCE", 0), "AMT_CREDIT_LIMIT_ACTUAL")
    return card.groupBy("SK_ID_CURR").agg(
        exact_avg(utilization).alias("avg_cc_limit_utilization"),
        F.max(utilization).alias("max_cc_limit_utilization"),
        safe_div(F.sum(deficit), F.count("AMT_INST_MIN_REGULARITY")).alias("cc_min_payment_deficit_ratio"),
        F.coalesce(F.max(F.when(F.col("MONTHS_BALANCE") >= -12, F.col("SK_DPD"))), F.lit(0))
        .alias("max_cc_sk_dpd_last_12m"),
        F.count_distinct("SK_ID_PREV").alias("total_cc_card_count"),
    )


def int_credit_card_kpis(card: DataFrame) -> DataFrame:
    return _as_customer_id(credit_card_kpis_by_customer(card))


# --------------------------------------------------------------------------- instalments

INSTALMENT_KEYS = ["SK_ID_CURR", "SK_ID_PREV", "NUM_INSTALMENT_VERSION", "NUM_INSTALMENT_NUMBER"]


def int_installments_features(inst: DataFrame) -> DataFrame:
    """Collapse several payments of one instalment into one row (Q3)."""
    per = inst.groupBy(*INSTALMENT_KEYS).agg(
        F.max("DAYS_INSTALMENT").alias("DAYS_INSTALMENT"),
        F.max("DAYS_ENTRY_PAYMENT").alias("SON_ODEME_GUNU"),
        F.max("AMT_INSTALMENT").alias("AMT_INSTALMENT"),
        money_sum("AMT_PAYMENT").alias("TOPLAM_ODENEN_TUTAR"),
    )
    return per.select(
        *INSTALMENT_KEYS, "DAYS_INSTALMENT", "SON_ODEME_GUNU", "AMT_INSTALMENT", "TOPLAM_ODENEN_TUTAR",
        (F.col("SON_ODEME_GUNU") - F.col("DAYS_INSTALMENT")).alias("GECIKME_GUNU"),
        (F.col("AMT_INSTALMENT") - F.col("TOPLAM_ODENEN_TUTAR")).alias("ODEME_FARKI"),
    )


def int_installments_customer_features(inst_features: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    delay = F.col("GECIKME_GUNU")
    short = count_if(F.col("ODEME_FARKI") > 0)
    late = count_if(delay > 0)
    return inst_features.groupBy("SK_ID_CURR").agg(
        n.alias("TOPLAM_TAKSIT_SAYISI"),
        F.count_distinct("SK_ID_PREV").alias("ESKI_KREDI_SAYISI"),
        late.alias("GEC_ODEME_SAYISI"),
        count_if(delay == 0).alias("ZAMANINDA_ODEME_SAYISI"),
        count_if(delay < 0).alias("ERKEN_ODEME_SAYISI"),
        short.alias("EKSIK_ODEME_SAYISI"),
        F.round(safe_div(late, n) * 100, 2).alias("GEC_ODEME_ORANI"),
        F.round(safe_div(short, n) * 100, 2).alias("EKSIK_ODEME_ORANI"),
        F.avg(delay).alias("ORTALAMA_GECIKME_GUNU"),
        F.max(delay).alias("MAKS_GECIKME_GUNU"),
    )


def installments_payment_kpis_by_customer(inst: DataFrame) -> DataFrame:
    """Per payment, as the reference does (Q3: each payment counts as an instalment)."""
    due, paid_day = F.col("DAYS_INSTALMENT"), F.col("DAYS_ENTRY_PAYMENT")
    delay = greatest_nullprop(paid_day - due, 0)
    is_late = F.when(paid_day > due, 1).otherwise(0)
    is_under = F.when(F.col("AMT_PAYMENT") < F.col("AMT_INSTALMENT"), 1).otherwise(0)
    n = F.count(F.lit(1))
    return inst.groupBy("SK_ID_CURR").agg(
        F.avg(delay).alias("avg_payment_delay_days"),
        F.max(delay).alias("max_payment_delay_days"),
        safe_div(F.sum(is_late), n).alias("late_payment_ratio"),
        safe_div(F.sum(is_under), n).alias("underpayment_ratio"),
        safe_div(money_sum("AMT_PAYMENT"), money_sum("AMT_INSTALMENT")).alias("payment_completion_rate"),
        (F.coalesce(F.avg(F.when(due >= -180, delay)), F.lit(0.0)) - F.avg(delay))
        .alias("recent_payment_delay_trend"),
        n.alias("total_installment_count"),
    )


def int_installments_payment_kpis(inst: DataFrame) -> DataFrame:
    return _as_customer_id(installments_payment_kpis_by_customer(inst))


# --------------------------------------------------------------------------- POS / cash

def pos_cash_kpis_by_customer(pos_raw: DataFrame) -> DataFrame:
    """KPIs over the staged POS rows, grouped by the numeric customer id.

    ``stg_pos_cash_balance`` turns the ids into strings; here the same
    cleaning is applied but the numeric id is kept for grouping and joins.
    """
    from .staging import stg_pos_cash_balance

    staged = stg_pos_cash_balance(pos_raw, keep=("SK_ID_CURR", "SK_ID_PREV"))
    return _pos_cash_aggregate(staged, "SK_ID_CURR", "SK_ID_PREV")


def _pos_cash_aggregate(staged: DataFrame, key: str, loan: str = "previous_application_id") -> DataFrame:
    n = F.count(F.lit(1))
    dpd = F.col("days_past_due")
    last12 = F.col("months_balance") >= -12
    return staged.groupBy(key).agg(
        F.max(dpd).alias("max_pos_dpd_all_time"),
        F.max("days_past_due_with_tolerance").alias("max_pos_dpd_tolerance_all_time"),
        F.avg(dpd).alias("avg_pos_dpd_all_time"),
        safe_div(count_if(F.col("is_past_due")), n).alias("pos_dpd_month_ratio"),
        safe_div(count_if(F.col("days_past_due_with_tolerance") > 0), n).alias("pos_dpd_tolerance_month_ratio"),
        F.coalesce(F.max(F.when(last12, dpd)), F.lit(0)).alias("max_pos_dpd_last_12m"),
        count_if(last12 & F.col("is_past_due")).alias("pos_dpd_months_count_last_12m"),
        safe_div(count_if(F.col("is_completed")), n).alias("pos_completed_contracts_ratio"),
        F.avg("remaining_instalment_count").alias("avg_pos_remaining_instalments"),
        F.count_distinct(loan).alias("total_pos_loan_count"),
        n.alias("total_pos_months_count"),
    )


def int_pos_cash_kpis(pos_stg: DataFrame) -> DataFrame:
    """Over ``stg_pos_cash_balance`` output, exactly as the reference (string key)."""
    return _pos_cash_aggregate(pos_stg, "customer_id")


def int_pos_cash_kpis_from_raw(pos_raw: DataFrame) -> DataFrame:
    """The same KPI set grouped by the numeric ids (injective casts), ``customer_id`` cast once per customer."""
    return _as_customer_id(pos_cash_kpis_by_customer(pos_raw))
