"""Staging: clean each raw table without changing its grain (row count in = out).

Every function is a projection over one raw DataFrame, so Catalyst collapses
it into the scan (column pruning reaches parquet; no shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.compat import to_int_half_away, trim_ws

SENTINEL_DAYS = 365243  # Fixed value: "no date" code of the day-offset columns.


def stg_application_train(app: DataFrame) -> DataFrame:
    return app.select(
        F.col("SK_ID_CURR").cast("bigint").alias("sk_id_curr"),
        F.col("TARGET").cast("bigint").alias("target"),
        "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3",
        "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY",
        "DAYS_BIRTH", "DAYS_EMPLOYED",
        "OCCUPATION_TYPE",
    )


def _flag_null(c: str) -> F.Column:
    return F.when(F.col(c).isNull(), 1).otherwise(0).cast("bigint")


def stg_application_train_clean(app: DataFrame) -> DataFrame:
    head = ["SK_ID_CURR", "TARGET", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
    dropped = {c.lower() for c in head + ["OCCUPATION_TYPE"]}
    rest = [c for c in app.columns if c.lower() not in dropped]
    return app.select(
        *head,
        _flag_null("EXT_SOURCE_1").alias("is_ext_source_1_missing"),
        _flag_null("EXT_SOURCE_3").alias("is_ext_source_3_missing"),
        F.coalesce(F.col("OCCUPATION_TYPE"), F.lit("Unknown")).alias("occupation_type_clean"),
        _flag_null("OCCUPATION_TYPE").alias("is_occupation_missing"),
        *rest,
    )


BUREAU_COLUMNS = [
    "SK_ID_CURR", "SK_ID_BUREAU", "CREDIT_ACTIVE", "CREDIT_CURRENCY", "DAYS_CREDIT",
    "CREDIT_DAY_OVERDUE", "DAYS_CREDIT_ENDDATE", "DAYS_ENDDATE_FACT", "AMT_CREDIT_MAX_OVERDUE",
    "CNT_CREDIT_PROLONG", "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM_LIMIT",
    "AMT_CREDIT_SUM_OVERDUE", "CREDIT_TYPE", "DAYS_CREDIT_UPDATE", "AMT_ANNUITY",
]


def stg_bureau(bureau: DataFrame) -> DataFrame:
    return bureau.select(*BUREAU_COLUMNS)


def stg_bureau_balance(balance: DataFrame) -> DataFrame:
    return balance.select("SK_ID_BUREAU", "MONTHS_BALANCE", "STATUS")


def stg_credit_card_balance(card: DataFrame) -> DataFrame:
    return card.select(
        "SK_ID_CURR", "SK_ID_PREV", "MONTHS_BALANCE", "AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL",
        "AMT_INST_MIN_REGULARITY", "AMT_PAYMENT_CURRENT", "AMT_PAYMENT_TOTAL_CURRENT",
        "NAME_CONTRACT_STATUS", "SK_DPD", "SK_DPD_DEF",
    )


def stg_installments_payments(inst: DataFrame) -> DataFrame:
    return inst.select(
        "SK_ID_CURR", "SK_ID_PREV", "NUM_INSTALMENT_VERSION", "NUM_INSTALMENT_NUMBER",
        "DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT", "AMT_INSTALMENT", "AMT_PAYMENT",
    )


def _norm(c: str) -> F.Column:
    """``trim(lower(x))`` with the reference's white-space-aware trim."""
    return trim_ws(F.lower(F.col(c)))


def stg_pos_cash_balance(pos: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` passes raw columns through (used to keep the numeric id for joins)."""
    status = _norm("NAME_CONTRACT_STATUS")
    dpd = F.coalesce(F.col("SK_DPD"), F.lit(0))
    return pos.select(
        F.col("SK_ID_PREV").cast("string").alias("previous_application_id"),
        F.col("SK_ID_CURR").cast("string").alias("customer_id"),
        to_int_half_away("MONTHS_BALANCE").alias("months_balance"),
        to_int_half_away("CNT_INSTALMENT").alias("total_instalment_count"),
        to_int_half_away("CNT_INSTALMENT_FUTURE").alias("remaining_instalment_count"),
        status.alias("contract_status"),
        to_int_half_away(dpd).alias("days_past_due"),
        to_int_half_away(F.coalesce(F.col("SK_DPD_DEF"), F.lit(0))).alias("days_past_due_with_tolerance"),
        F.coalesce(dpd > 0, F.lit(False)).alias("is_past_due"),
        F.coalesce(
            (status == "completed") | (F.coalesce(F.col("CNT_INSTALMENT_FUTURE"), F.lit(0)) == 0),
            F.lit(False),
        ).alias("is_completed"),
        *keep,
    )


def _no_sentinel_int(c: str) -> F.Column:
    return to_int_half_away(F.nullif(F.col(c), F.lit(SENTINEL_DAYS)))


def stg_previous_application(prev: DataFrame) -> DataFrame:
    numeric = "decimal(38,9)"  # the reference dialect's NUMERIC
    status = _norm("NAME_CONTRACT_STATUS")
    return prev.select(
        F.col("SK_ID_PREV").cast("string").alias("previous_application_id"),
        F.col("SK_ID_CURR").cast("string").alias("customer_id"),
        _norm("NAME_CONTRACT_TYPE").alias("contract_type"),
        status.alias("contract_status"),
        _norm("NAME_PAYMENT_TYPE").alias("payment_type"),
        _norm("CODE_REJECT_REASON").alias("reject_reason"),
        _norm("NAME_CLIENT_TYPE").alias("client_type"),
        _norm("NAME_PORTFOLIO").alias("portfolio"),
        _norm("NAME_PRODUCT_TYPE").alias("product_type"),
        _norm("PRODUCT_COMBINATION").alias("product_combination"),
        _norm("NAME_YIELD_GROUP").alias("yield_group"),
        F.col("AMT_ANNUITY").cast(numeric).alias("annuity_amount"),
        F.col("AMT_APPLICATION").cast(numeric).alias("application_amount"),
        F.col("AMT_CREDIT").cast(numeric).alias("credit_amount"),
        F.coalesce(F.col("AMT_DOWN_PAYMENT"), F.lit(0.0)).cast(numeric).alias("down_payment_amount"),
        F.col("AMT_GOODS_PRICE").cast(numeric).alias("goods_price_amount"),
        F.col("RATE_DOWN_PAYMENT").cast("double").alias("down_payment_rate"),
        F.col("RATE_INTEREST_PRIMARY").cast("double").alias("primary_interest_rate"),
        F.col("RATE_INTEREST_PRIVILEGED").cast("double").alias("privileged_interest_rate"),
        _norm("WEEKDAY_APPR_PROCESS_START").alias("approval_process_day"),
        to_int_half_away("HOUR_APPR_PROCESS_START").alias("approval_process_hour"),
        to_int_half_away("DAYS_DECISION").alias("days_decision"),
        _no_sentinel_int("DAYS_FIRST_DRAWING").alias("days_first_drawing"),
        _no_sentinel_int("DAYS_FIRST_DUE").alias("days_first_due"),
        _no_sentinel_int("DAYS_LAST_DUE_1ST_VERSION").alias("days_last_due_1st_version"),
        _no_sentinel_int("DAYS_LAST_DUE").alias("days_last_due"),
        _no_sentinel_int("DAYS_TERMINATION").alias("days_termination"),
        _norm("NAME_TYPE_SUITE").alias("suite_type"),
        _norm("NAME_GOODS_CATEGORY").alias("goods_category"),
        _norm("CHANNEL_TYPE").alias("channel_type"),
        to_int_half_away("SELLERPLACE_AREA").alias("sellerplace_area"),
        _norm("NAME_SELLER_INDUSTRY").alias("seller_industry"),
        to_int_half_away("CNT_PAYMENT").alias("payment_term_count"),
        F.col("FLAG_LAST_APPL_PER_CONTRACT").cast("boolean").alias("is_last_application_per_contract"),
        F.col("NFLAG_LAST_APPL_IN_DAY").cast("boolean").alias("is_last_application_in_day"),
        F.coalesce(F.col("NFLAG_INSURED_ON_APPROVAL") == 1.0, F.lit(False)).alias("is_insured_on_approval"),
        F.coalesce(status == "approved", F.lit(False)).alias("is_approved"),
        F.coalesce(status == "refused", F.lit(False)).alias("is_refused"),
    )
