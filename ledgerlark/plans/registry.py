"""

The audit statements are generic operators (``operators.profile`` etc.)
bound here to the bureau tables with the reference's output names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.compat import count_if, distinct_joined, exact_avg, greatest_nullprop, safe_bigint
from ..operators import checks as ck
from ..operators import integrity as ig
from ..operators import profile as pf
from ..operators import reports as rp
from ..operators import rules as ru
from .audit_spec import CARD_TARGET, CATEGORY_COLS, INST_TARGET, NULL_PCT_COLS, PROFILE_COLS
from .catalog import Catalog

QueryFn = Callable[[Catalog], DataFrame]

# Fixed value: smallest occupation that the occupation KPI reports.
KPI06_MIN_COUNT = 500

# Allowed codes of the data checks.
TARGET_VALUES = [0, 1]
CREDIT_ACTIVE_VALUES = ["Active", "Closed", "Sold", "Bad debt"]
DPD_BUCKET_VALUES = [0, 1, 2, 3, 4, 5]
STATUS_VALUES = ["0", "1", "2", "3", "4", "5", "C", "X"]


def _business_rules(c: Catalog) -> DataFrame:
    # The rule names and thresholds of the business-rule audit (18250 days = 50 years).
    col = F.col
    return ru.rule_counts(c.src["bureau"], {
        "r1_debt_exceeds_credit": col("AMT_CREDIT_SUM_DEBT") > col("AMT_CREDIT_SUM"),
        "r2_closed_but_indebted": (col("CREDIT_ACTIVE") == "Closed") & (col("AMT_CREDIT_SUM_DEBT") > 0),
        "r3_closed_without_end_date": (col("CREDIT_ACTIVE") == "Closed") & col("DAYS_ENDDATE_FACT").isNull(),
        "r4_active_but_ended": (col("CREDIT_ACTIVE") == "Active") & col("DAYS_ENDDATE_FACT").isNotNull(),
        "r5_ends_before_it_starts": col("DAYS_CREDIT_ENDDATE") < col("DAYS_CREDIT"),
        "r6_applied_in_the_future": col("DAYS_CREDIT") > 0,
        "r7_ends_beyond_50_years": col("DAYS_CREDIT_ENDDATE") > 18250,
        "r7b_ended_over_50_years_ago": col("DAYS_CREDIT_ENDDATE") < -18250,
        "r8_late_but_owes_nothing": (col("CREDIT_DAY_OVERDUE") > 0) & (col("AMT_CREDIT_SUM_OVERDUE") == 0),
        "r8b_owes_but_not_late": (col("CREDIT_DAY_OVERDUE") == 0) & (col("AMT_CREDIT_SUM_OVERDUE") > 0),
        "r9_max_below_current": col("AMT_CREDIT_MAX_OVERDUE") < col("AMT_CREDIT_SUM_OVERDUE"),
        "r10_zero_value_credit": col("AMT_CREDIT_SUM") == 0,
        "r11_limit_on_non_card": (col("AMT_CREDIT_SUM_LIMIT") > 0) & (col("CREDIT_TYPE") != "Credit card"),
    })


def _negative_debt(c: Catalog) -> DataFrame:
    debt, lim = F.col("AMT_CREDIT_SUM_DEBT"), F.col("AMT_CREDIT_SUM_LIMIT")
    return ru.cohort(c.src["bureau"], debt < 0, [
        F.count(F.lit(1)).alias("negative_debt_rows"),
        count_if(F.abs(debt) == lim).alias("debt_mirrors_limit_exactly"),
        count_if(lim.isNull()).alias("limit_is_null"),
        count_if(lim == 0).alias("limit_is_zero"),
        distinct_joined("CREDIT_TYPE").alias("affected_credit_types"),
        distinct_joined("CREDIT_ACTIVE").alias("affected_statuses"),
        F.min(debt).alias("most_negative"),
        F.round(exact_avg(debt), 2).alias("average_negative"),
    ])


def _sentinels(c: Catalog) -> DataFrame:
    col = F.col
    nines = [9999, 99999, 999999]
    return pf.counters(c.src["bureau"], {
        "s_365243_days_credit": col("DAYS_CREDIT") == 365243,
        "s_365243_enddate": col("DAYS_CREDIT_ENDDATE") == 365243,
        "s_365243_enddate_fact": col("DAYS_ENDDATE_FACT") == 365243,
        "s_365243_update": col("DAYS_CREDIT_UPDATE") == 365243,
        "s_minus1_prolong": col("CNT_CREDIT_PROLONG") == -1,
        "s_minus1_credit_sum": col("AMT_CREDIT_SUM") == -1,
        "s_nines_credit_sum": col("AMT_CREDIT_SUM").isin(nines),
        "s_nines_annuity": col("AMT_ANNUITY").isin(nines),
        "credit_sum_exactly_zero": col("AMT_CREDIT_SUM") == 0,
    })


def _blank_padded(c: Catalog) -> DataFrame:
    preds = {}
    preds.update(pf.blank_padded_predicates("CREDIT_ACTIVE", empty="empty_credit_active",
                                            blank="blank_credit_active", padded="padded_credit_active"))
    preds.update(pf.blank_padded_predicates("CREDIT_CURRENCY", empty="empty_currency", padded="padded_currency"))
    preds.update(pf.blank_padded_predicates("CREDIT_TYPE", empty="empty_credit_type", padded="padded_credit_type"))
    return pf.counters(c.src["bureau"], preds)


def _balance_completeness(c: Catalog) -> DataFrame:
    s = F.col("STATUS")
    preds = {
        "null_loan_id": F.col("SK_ID_BUREAU").isNull(),
        "null_month": F.col("MONTHS_BALANCE").isNull(),
        "null_status": s.isNull(),
    }
    preds.update(pf.blank_padded_predicates("STATUS", empty="empty_status", padded="padded_status"))
    preds["status_wrong_length"] = F.length(s) != 1
    return pf.counters(c.src["bureau_balance"], preds, total="total_rows")


def _checks_unique(c: Catalog) -> DataFrame:
    s = c.src
    return ck.union_all([
        ck.check_unique(s["application_train"], "SK_ID_CURR", "application_train"),
        ck.check_unique(s["application_test"], "SK_ID_CURR", "application_test"),
        ck.check_unique(s["bureau"], "SK_ID_BUREAU", "bureau"),
        ck.check_unique(s["previous_application"], "SK_ID_PREV", "previous_application"),
        ck.check_unique(c.stg_application_train_clean, "SK_ID_CURR", "stg_application_train_clean"),
        ck.check_unique(c.int_application_train_features, "SK_ID_CURR", "int_application_train_features"),
    ])


def _checks_not_null(c: Catalog) -> DataFrame:
    s = c.src
    return ck.union_all([
        ck.check_not_null(s["application_train"], ["SK_ID_CURR", "TARGET"], "application_train"),
        ck.check_not_null(s["application_test"], ["SK_ID_CURR"], "application_test"),
        ck.check_not_null(s["bureau"], ["SK_ID_BUREAU", "SK_ID_CURR"], "bureau"),
        ck.check_not_null(s["bureau_balance"], ["SK_ID_BUREAU"], "bureau_balance"),
        ck.check_not_null(s["previous_application"], ["SK_ID_PREV", "SK_ID_CURR"], "previous_application"),
        ck.check_not_null(s["POS_CASH_balance"], ["SK_ID_PREV", "SK_ID_CURR", "MONTHS_BALANCE"],
                          "POS_CASH_balance"),
        ck.check_not_null(c.stg_application_train_clean, ["SK_ID_CURR", "TARGET"], "stg_application_train_clean"),
        ck.check_not_null(c.int_application_train_features, ["SK_ID_CURR", "TARGET"],
                          "int_application_train_features"),
    ])


def _checks_accepted_values(c: Catalog) -> DataFrame:
    s = c.src
    dpd = safe_bigint("STATUS")
    return ck.union_all([
        ck.check_accepted_values(s["application_train"], "TARGET", TARGET_VALUES, "application_train"),
        ck.check_accepted_values(s["bureau"], "CREDIT_ACTIVE", CREDIT_ACTIVE_VALUES, "bureau"),
        ck.check_accepted_values(s["bureau_balance"], dpd, DPD_BUCKET_VALUES, "bureau_balance",
                                 name="dpd_bucket"),  # NULL is no failure
    ])


QUERIES: dict[str, QueryFn] = {
    # staging
    "stg_application_train": lambda c: c.stg_application_train,
    "stg_application_train_clean": lambda c: c.stg_application_train_clean,
    "stg_bureau": lambda c: c.stg_bureau,
    "stg_bureau_balance": lambda c: c.stg_bureau_balance,
    "stg_credit_card_balance": lambda c: c.stg_credit_card_balance,
    "stg_installments_payments": lambda c: c.stg_installments_payments,
    "stg_pos_cash_balance": lambda c: c.stg_pos_cash_balance,
    "stg_previous_application": lambda c: c.stg_previous_application,
    # intermediate
    "int_application_train_features": lambda c: c.int_application_train_features,
    "int_bureau_balance_summarized": lambda c: c.int_bureau_balance_summarized,
    "int_bureau_enriched": lambda c: c.int_bureau_enriched,
    "int_bureau_kpis": lambda c: c.int_bureau_kpis,
    "int_credit_card_features": lambda c: c.int_credit_card_features,
    "int_credit_card_kpis": lambda c: c.int_credit_card_kpis,
    "int_installments_features": lambda c: c.int_installments_features,
    "int_installments_customer_features": lambda c: c.int_installments_customer_features,
    "int_installments_payment_kpis": lambda c: c.int_installments_payment_kpis,
    "int_pos_cash_kpis": lambda c: c.int_pos_cash_kpis,
    # marts and reports
    "mart_customer_credit_history": lambda c: c.mart_customer_credit_history,
    "mart_target_kpi_analysis": lambda c: c.mart_target_kpi_analysis,
    "fct_ml_payment_behavior_features": lambda c: c.fct_ml_payment_behavior_features,
    "rpt_egitim_gelir_odeme": lambda c: c.rpt_egitim_gelir_odeme(),
    "rpt_gelir_dilimleri": lambda c: c.rpt_gelir_dilimleri(),
    "rpt_kredi_gelir_orani": lambda c: c.rpt_kredi_gelir_orani(),
    "rpt_yas_egitim_capraz": lambda c: c.rpt_yas_egitim_capraz(),
    "rpt_yas_gelir_odeme": lambda c: c.rpt_yas_gelir_odeme(),
    # analytics
    "kpi_01_default_rate": lambda c: rp.kpi_01_default_rate(c.int_application_train_features),
    "kpi_02_default_by_income_band": lambda c: rp.kpi_02_default_by_income_band(c.int_application_train_features),
    "kpi_03_default_by_credit_band": lambda c: rp.kpi_03_default_by_credit_band(c.int_application_train_features),
    "kpi_04_default_by_burden_decile":
        lambda c: rp.kpi_04_default_by_burden_decile(c.int_application_train_features),
    "kpi_05_default_by_age_band": lambda c: rp.kpi_05_default_by_age_band(c.int_application_train_features),
    "kpi_06_default_by_occupation":
        lambda c: rp.kpi_06_default_by_occupation(c.int_application_train_features, KPI06_MIN_COUNT),
    # audits: 01 structure and grain
    "an01_bureau_grain": lambda c: pf.grain(
        c.src["bureau"], "bureau", "SK_ID_BUREAU",
        {"distinct_keys": "distinct_bureau_ids", "duplicates": "duplicate_rows",
         "distinct_entities": "distinct_customers", "per_entity": "avg_loans_per_customer"},
        entity="SK_ID_CURR", per_entity_digits=2,
        null_cols={"null_bureau_ids": "SK_ID_BUREAU", "null_customer_ids": "SK_ID_CURR"}),
    "an01_balance_grain": lambda c: pf.grain(
        c.src["bureau_balance"], "bureau_balance", ["SK_ID_BUREAU", "MONTHS_BALANCE"],
        {"distinct_first_key": "distinct_loans", "distinct_keys": "distinct_loan_month_pairs",
         "duplicates": "duplicate_rows", "per_entity": "avg_months_per_loan",
         "range_min": "oldest_month_index", "range_max": "newest_month_index"},
        per_entity_digits=1, range_col="MONTHS_BALANCE",
        null_cols={"null_loan_ids": "SK_ID_BUREAU", "null_month_index": "MONTHS_BALANCE"}),
    "an01_full_row_duplicates": lambda c: pf.full_row_duplicates(c.src["bureau"]),
    # 02 completeness and sentinels
    "an02_null_pct": lambda c: pf.null_pct(c.src["bureau"], dict(NULL_PCT_COLS)),
    "an02_blank_padded": _blank_padded,
    "an02_sentinels": _sentinels,
    "an02_balance_completeness": _balance_completeness,
    # 03-04 profiles
    "an03_numeric_profile": lambda c: pf.numeric_profile(c.src["bureau"], PROFILE_COLS),
    "an04_category_profile": lambda c: pf.category_profile(c.src["bureau"], CATEGORY_COLS),
    "an04_spelling_variants": lambda c: pf.spelling_variants(c.src["bureau"], "CREDIT_TYPE"),
    "an04_status_distribution": lambda c: pf.value_distribution(c.src["bureau_balance"], "STATUS", STATUS_VALUES),
    # 05 business rules
    "an05_business_rules": _business_rules,
    "an05_negative_debt": _negative_debt,
    "an05_worst_debt_over_credit": lambda c: ru.top_violations(
        c.src["bureau"], F.col("AMT_CREDIT_SUM_DEBT") > F.col("AMT_CREDIT_SUM"),
        (F.col("AMT_CREDIT_SUM_DEBT") - F.col("AMT_CREDIT_SUM")).desc(),
        ["SK_ID_BUREAU", "SK_ID_CURR", "CREDIT_ACTIVE", "CREDIT_TYPE", "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT",
         "AMT_CREDIT_SUM_LIMIT", "DAYS_CREDIT", "DAYS_CREDIT_ENDDATE", "DAYS_ENDDATE_FACT"],
        n=20, tie="SK_ID_BUREAU"),
    # 06 referential integrity
    "an06_key_coverage": lambda c: ig.key_coverage(c.src["bureau"], c.src["bureau_balance"], "SK_ID_BUREAU"),
    "an06_fanout_check": lambda c: ig.fanout(c.src["bureau_balance"], "SK_ID_BUREAU"),
    "an06_customer_coverage": lambda c: ig.customer_coverage(
        c.src["bureau"], c.src["application_train"], c.src["application_test"], key="SK_ID_CURR"),
    "an06_join_rowcount": lambda c: ig.join_rowcount(c.src["bureau"], c.src["bureau_balance"], "SK_ID_BUREAU"),
    # 07 missingness patterns
    "an07_enddate_nulls_by_status": lambda c: pf.missingness_by(
        c.src["bureau"], F.col("CREDIT_ACTIVE"), "CREDIT_ACTIVE", "rows_in_group",
        {"pct_null_end_date": (F.col("DAYS_ENDDATE_FACT").isNull(), 1)},
        extra={"null_end_date": F.col("DAYS_ENDDATE_FACT").isNull()}, order="count_desc"),
    "an07_max_overdue_null_groups": lambda c: pf.missingness_by(
        c.src["bureau"],
        F.when(F.col("AMT_CREDIT_MAX_OVERDUE").isNull(), F.lit("MAX_OVERDUE is NULL"))
        .otherwise(F.lit("MAX_OVERDUE has a value")),
        "group_label", "rows_in_group",
        {"pct_also_clean": ((F.col("AMT_CREDIT_SUM_OVERDUE") == 0) & (F.col("CREDIT_DAY_OVERDUE") == 0), 2)},
        extra={"also_zero_current_overdue": F.col("AMT_CREDIT_SUM_OVERDUE") == 0,
               "also_zero_overdue_days": F.col("CREDIT_DAY_OVERDUE") == 0}),
    "an07_nulls_by_credit_type": lambda c: pf.missingness_by(
        c.src["bureau"], F.col("CREDIT_TYPE"), "CREDIT_TYPE", "rows_in_group",
        {"pct_null_annuity": (F.col("AMT_ANNUITY").isNull(), 1),
         "pct_null_limit": (F.col("AMT_CREDIT_SUM_LIMIT").isNull(), 1),
         "pct_null_debt": (F.col("AMT_CREDIT_SUM_DEBT").isNull(), 1)}, order="count_desc"),
    "an07_nulls_by_year": lambda c: pf.missingness_by(
        c.src["bureau"], F.floor(F.lit(-1) * F.col("DAYS_CREDIT") / F.lit(365)).cast("bigint"),
        "years_before_application", "rows_in_bucket",
        {"pct_null_annuity": (F.col("AMT_ANNUITY").isNull(), 1),
         "pct_null_max_overdue": (F.col("AMT_CREDIT_MAX_OVERDUE").isNull(), 1),
         "pct_null_debt": (F.col("AMT_CREDIT_SUM_DEBT").isNull(), 1)}, order="group"),
    "an07_status_by_year": lambda c: pf.missingness_by(
        c.src["bureau_balance"], F.floor(F.lit(-1) * F.col("MONTHS_BALANCE") / F.lit(12)).cast("bigint"),
        "years_ago", "rows_in_bucket",
        {"pct_unknown": (F.col("STATUS") == "X", 1),
         "pct_closed": (F.col("STATUS") == "C", 1),
         "pct_delinquent": (F.col("STATUS").isin(["1", "2", "3", "4", "5"]), 2)}, order="group"),
    # target summaries over the target/KPI mart
    "an_card_by_target": lambda c: pf.mean_by(c.mart_target_kpi_analysis, "TARGET", dict(CARD_TARGET),
                                              "MUSTERI_SAYISI"),
    "an_instalments_by_target": lambda c: pf.mean_by(c.mart_target_kpi_analysis, "TARGET", dict(INST_TARGET),
                                                     "MUSTERI_SAYISI"),
    # data checks
    "check_unique": _checks_unique,
    "check_not_null": _checks_not_null,
    "check_accepted_values": _checks_accepted_values,
    # on the debt as the marts clean it (negative becomes zero); an05_negative_debt counts the raw ones
    "check_accepted_range": lambda c: ck.check_accepted_range(
        c.src["bureau"].withColumn("AMT_CREDIT_SUM_DEBT", greatest_nullprop("AMT_CREDIT_SUM_DEBT", 0)),
        "AMT_CREDIT_SUM_DEBT", "bureau", min_value=0),
    "check_join_preserves_rows": lambda c: ck.check_join_preserves_rows(
        c.stg_bureau, c.int_bureau_enriched, "SK_ID_BUREAU", "int_bureau_enriched"),
}
