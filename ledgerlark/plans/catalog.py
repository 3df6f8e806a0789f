"""The model DAG as lazily built, memoised DataFrames.

``Catalog(sources)`` plays the role of ``ref()``: each model is a property
computed once from its upstream models.  Models the reference materialises
as tables can be written once and read back (``materialize=True``): the
write goes to the shared folder named by ``spark.checkpoint.dir``, so a lost
executor only recomputes from the written table, never the whole lineage.
Without materialisation every model is a lazy plan and Catalyst optimises
the whole chain together (view semantics).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from ..operators import features as ft
from ..operators import marts as mt
from ..operators import reports as rp
from ..operators import staging as st

# Models the reference materialises as tables (the rest are views).
TABLE_MODELS = {
    "bureau_balance_loan_summary", "int_bureau_enriched", "mart_customer_credit_history",
    "int_installments_features", "int_credit_card_features", "mart_target_kpi_analysis",
    "fct_ml_payment_behavior_features",
}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; it must be configured, never guessed."""
    try:
        d = spark.sparkContext.getCheckpointDir()
    except PySparkException:  # Spark Connect: only the configuration is visible
        d = None
    d = d or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        raise RuntimeError("spark.checkpoint.dir is not set: materialised models need a shared folder")
    return d.rstrip("/")


class Catalog:
    def __init__(self, sources: dict[str, DataFrame], materialize: bool = False,
                 spark: SparkSession | None = None, run_id: str | None = None, dest: str | None = None) -> None:
        self.src = sources
        self.materialize = materialize
        self.spark = spark or next(iter(sources.values())).sparkSession
        self.run_id = run_id or uuid.uuid4().hex[:12]
        #: Folder of the materialised models, by default one under the shared folder.
        self.dest = dest
        #: Materialised models: name -> path.
        self.written: dict[str, str] = {}

    def _table(self, name: str, df: DataFrame) -> DataFrame:
        if not (self.materialize and name in TABLE_MODELS):
            return df
        from .publish import CONTRACTS, publish
        from .sinks import BUILD_MODELS, write_table

        root = self.dest or f"{shared_dir(self.spark)}/ledgerlark-tables/{self.run_id}"
        self.written[name] = publish(
            self.spark, name, root, lambda to: write_table(df, to, cluster_by=BUILD_MODELS.get(name, ())),
            self.spine_rows(CONTRACTS[name].spine))
        return self.spark.read.parquet(self.written[name])

    def spine_rows(self, spine: str | None) -> Callable[[], int] | None:
        """Counts the rows of the model ``spine``, when called."""
        return (lambda: getattr(self, spine).count()) if spine else None

    # ---------------------------------------------------------------- staging
    @cached_property
    def stg_application_train(self) -> DataFrame:
        return st.stg_application_train(self.src["application_train"])

    @cached_property
    def stg_application_train_clean(self) -> DataFrame:
        return st.stg_application_train_clean(self.src["application_train"])

    @cached_property
    def stg_bureau(self) -> DataFrame:
        return st.stg_bureau(self.src["bureau"])

    @cached_property
    def stg_bureau_balance(self) -> DataFrame:
        return st.stg_bureau_balance(self.src["bureau_balance"])

    @cached_property
    def stg_credit_card_balance(self) -> DataFrame:
        return st.stg_credit_card_balance(self.src["credit_card_balance"])

    @cached_property
    def stg_installments_payments(self) -> DataFrame:
        return st.stg_installments_payments(self.src["installments_payments"])

    @cached_property
    def stg_pos_cash_balance(self) -> DataFrame:
        return st.stg_pos_cash_balance(self.src["POS_CASH_balance"])

    @cached_property
    def stg_previous_application(self) -> DataFrame:
        return st.stg_previous_application(self.src["previous_application"])

    # ---------------------------------------------------------------- intermediate
    @cached_property
    def int_application_train_features(self) -> DataFrame:
        return ft.int_application_train_features(self.stg_application_train_clean)

    @cached_property
    def bureau_balance_loan_summary(self) -> DataFrame:
        return self._table("bureau_balance_loan_summary",
                           ft.bureau_balance_loan_summary(self.stg_bureau_balance))

    @cached_property
    def int_bureau_balance_summarized(self) -> DataFrame:
        return ft.int_bureau_balance_summarized(self.stg_bureau_balance, self.bureau_balance_loan_summary)

    @cached_property
    def int_bureau_enriched(self) -> DataFrame:
        return self._table("int_bureau_enriched",
                           ft.int_bureau_enriched(self.stg_bureau, self.bureau_balance_loan_summary))

    @cached_property
    def bureau_kpis_by_customer(self) -> DataFrame:
        return ft.bureau_kpis_by_customer(self.stg_bureau, self.bureau_balance_loan_summary)

    @cached_property
    def int_bureau_kpis(self) -> DataFrame:
        return ft.int_bureau_kpis(self.stg_bureau, self.bureau_balance_loan_summary)

    @cached_property
    def int_credit_card_features(self) -> DataFrame:
        return self._table("int_credit_card_features", ft.int_credit_card_features(self.stg_credit_card_balance))

    @cached_property
    def credit_card_kpis_by_customer(self) -> DataFrame:
        return ft.credit_card_kpis_by_customer(self.stg_credit_card_balance)

    @cached_property
    def int_credit_card_kpis(self) -> DataFrame:
        return ft.int_credit_card_kpis(self.stg_credit_card_balance)

    @cached_property
    def int_installments_features(self) -> DataFrame:
        src = getattr(self.src, "by_loan", self.src)
        return self._table("int_installments_features", ft.int_installments_features(
            st.stg_installments_payments(src["installments_payments"])))

    @cached_property
    def int_installments_customer_features(self) -> DataFrame:
        return ft.int_installments_customer_features(self.int_installments_features)

    @cached_property
    def installments_payment_kpis_by_customer(self) -> DataFrame:
        return ft.installments_payment_kpis_by_customer(self.stg_installments_payments)

    @cached_property
    def int_installments_payment_kpis(self) -> DataFrame:
        return ft.int_installments_payment_kpis(self.stg_installments_payments)

    @cached_property
    def pos_cash_kpis_by_customer(self) -> DataFrame:
        return ft.pos_cash_kpis_by_customer(self.src["POS_CASH_balance"])

    @cached_property
    def int_pos_cash_kpis(self) -> DataFrame:
        return ft.int_pos_cash_kpis_from_raw(self.src["POS_CASH_balance"])

    # ---------------------------------------------------------------- marts
    @cached_property
    def mart_customer_credit_history(self) -> DataFrame:
        return self._table("mart_customer_credit_history",
                           mt.mart_customer_credit_history(self.int_bureau_enriched))

    @cached_property
    def mart_target_kpi_analysis(self) -> DataFrame:
        return self._table("mart_target_kpi_analysis", mt.mart_target_kpi_analysis(
            self.int_application_train_features, self.int_installments_customer_features,
            self.int_credit_card_features))

    @cached_property
    def fct_ml_payment_behavior_features(self) -> DataFrame:
        return self._table("fct_ml_payment_behavior_features", mt.fct_ml_payment_behavior_features(
            self.stg_application_train, self.installments_payment_kpis_by_customer,
            self.credit_card_kpis_by_customer, self.pos_cash_kpis_by_customer,
            self.bureau_kpis_by_customer))

    # ---------------------------------------------------------------- reports
    def rpt_egitim_gelir_odeme(self) -> DataFrame:
        return rp.rpt_egitim_gelir_odeme(self.src["application_train"], self.mart_customer_credit_history)

    def rpt_gelir_dilimleri(self) -> DataFrame:
        return rp.rpt_gelir_dilimleri(self.src["application_train"])

    def rpt_kredi_gelir_orani(self) -> DataFrame:
        return rp.rpt_kredi_gelir_orani(self.src["application_train"])

    def rpt_yas_egitim_capraz(self) -> DataFrame:
        return rp.rpt_yas_egitim_capraz(self.src["application_train"])

    def rpt_yas_gelir_odeme(self) -> DataFrame:
        return rp.rpt_yas_gelir_odeme(self.src["application_train"], self.mart_customer_credit_history)
