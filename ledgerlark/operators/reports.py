"""Reports over the raw applications (band, decile and quantile tables) and analytics KPIs.

All reports end in a ``groupBy`` on a handful of band values: Spark runs a
partial aggregate per task, so the output stage sees a few rows per task
whatever the data size.  Quantiles are exact at any size (:mod:`ranks`):
values are counted in cells, so no sketches of a group meet in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.compat import band, count_if, default_pct, exact_avg, pct, safe_div
from .ntile import distributed_ntile
from .ranks import quantile_table

# Band edges and labels of the reports (text as the reference writes it).
CREDIT_INCOME_EDGES = [1, 2, 3, 5]
CREDIT_INCOME_LABELS = [
    "1_gelirin_altinda (<1x)", "2_gelirin_1_2_kati", "3_gelirin_2_3_kati",
    "4_gelirin_3_5_kati", "5_gelirin_5_kati_ustu",
]
AGE3_EDGES = [30, 45]
AGE3_LABELS = ["1_genc (21-29)", "2_orta (30-44)", "3_olgun (45+)"]
AGE5_EDGES = [30, 40, 50, 60]
AGE5_LABELS = ["1_genc (21-29)", "2_otuzlar (30-39)", "3_kirklar (40-49)",
               "4_elliler (50-59)", "5_altmis_arti (60+)"]
HIGHER_EDUCATION = ["Academic degree", "Higher education"]
CREDIT_EDGES = [100000, 200000, 500000]
CREDIT_LABELS = ["<100k", "100-200k", "200-500k", "500k+"]


def _age_years_365() -> F.Column:
    """``floor(-DAYS_BIRTH/365)``: the reports' age (Q8: the features use 365.25)."""
    return F.floor(-F.col("DAYS_BIRTH") / F.lit(365))


def _with_history(app: DataFrame, history: DataFrame, cols: list[str]) -> DataFrame:
    """Left join of applications to the per-customer credit history (unique key)."""
    h = history.select(F.col("SK_ID_CURR").alias("_m_key"), *cols)
    return app.join(h, app["SK_ID_CURR"] == h["_m_key"], "left")


def rpt_egitim_gelir_odeme(app: DataFrame, history: DataFrame) -> DataFrame:
    j = _with_history(app, history, ["total_late_months", "debt_to_credit_ratio"])
    # the join keeps the applications as they are, so their incomes can be ranked before it
    q = quantile_table(app, "AMT_INCOME_TOTAL", [0.5, 0.25, 0.75], "NAME_EDUCATION_TYPE")
    n = F.count(F.lit(1))
    out = j.groupBy(F.col("NAME_EDUCATION_TYPE").alias("egitim")).agg(
        n.alias("musteri_sayisi"),
        default_pct().alias("temerrut_pct"),
        pct(count_if(F.col("total_late_months") > 0), n, 2).alias("gecmiste_gecikme_pct"),
        F.round(exact_avg("debt_to_credit_ratio"), 3).alias("ort_borc_kredi_orani"),
    )
    out = out.join(F.broadcast(q), out["egitim"].eqNullSafe(q["_g"]), "left")
    return out.select(
        "egitim", "musteri_sayisi",
        F.round(F.col("_q")[0], 0).alias("gelir_medyan"),
        F.round(F.col("_q")[1], 0).alias("gelir_p25"),
        F.round(F.col("_q")[2], 0).alias("gelir_p75"),
        "temerrut_pct", "gecmiste_gecikme_pct", "ort_borc_kredi_orani",
    )


def rpt_gelir_dilimleri(app: DataFrame, n: int = 10) -> DataFrame:
    """Income deciles; ties broken by SK_ID_CURR so the split is deterministic (T8)."""
    ranked = distributed_ntile(app.select("SK_ID_CURR", "TARGET", "AMT_INCOME_TOTAL"),
                               "AMT_INCOME_TOTAL", "SK_ID_CURR", n, "gelir_dilimi")
    return ranked.groupBy("gelir_dilimi").agg(
        F.round(F.min("AMT_INCOME_TOTAL"), 0).alias("dilim_alt_siniri"),
        F.round(F.max("AMT_INCOME_TOTAL"), 0).alias("dilim_ust_siniri"),
        F.count(F.lit(1)).alias("musteri_sayisi"),
        default_pct().alias("temerrut_pct"),
    )


def rpt_kredi_gelir_orani(app: DataFrame) -> DataFrame:
    ratio = safe_div("AMT_CREDIT", "AMT_INCOME_TOTAL")
    return app.groupBy(band(ratio, CREDIT_INCOME_EDGES, CREDIT_INCOME_LABELS).alias("oran_grubu")).agg(
        F.count(F.lit(1)).alias("musteri_sayisi"),
        default_pct().alias("temerrut_pct"),
    )


def rpt_yas_egitim_capraz(app: DataFrame) -> DataFrame:
    edu = F.col("NAME_EDUCATION_TYPE")
    edu_band = (F.when(edu.isin(HIGHER_EDUCATION), F.lit("yuksek_egitim"))
                .when(edu == "Incomplete higher", F.lit("yarim_yuksek"))
                .otherwise(F.lit("orta_ve_alti")))
    return app.groupBy(
        band(_age_years_365(), AGE3_EDGES, AGE3_LABELS).alias("yas_grubu"),
        edu_band.alias("egitim_bandi"),
    ).agg(
        F.count(F.lit(1)).alias("musteri_sayisi"),
        default_pct().alias("temerrut_pct"),
    )


def rpt_yas_gelir_odeme(app: DataFrame, history: DataFrame) -> DataFrame:
    j = _with_history(app, history, ["total_late_months", "loans_opened_last_year"])
    age = band(_age_years_365(), AGE5_EDGES, AGE5_LABELS).alias("yas_grubu")
    q = quantile_table(app.select(age, "AMT_INCOME_TOTAL"), "AMT_INCOME_TOTAL", [0.5], "yas_grubu")
    n = F.count(F.lit(1))
    out = j.groupBy(age).agg(
        n.alias("musteri_sayisi"),
        default_pct().alias("temerrut_pct"),
        pct(count_if(F.col("total_late_months") > 0), n, 2).alias("gecmiste_gecikme_pct"),
        F.round(F.avg("loans_opened_last_year"), 2).alias("son_yil_acilan_kredi_ort"),
    )
    return out.join(F.broadcast(q), out["yas_grubu"].eqNullSafe(q["_g"]), "left").select(
        "yas_grubu", "musteri_sayisi", F.round(F.col("_q")[0], 0).alias("gelir_medyan"),
        "temerrut_pct", "gecmiste_gecikme_pct", "son_yil_acilan_kredi_ort")


# --------------------------------------------------------------------------- analytics KPIs

def kpi_01_default_rate(feat: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return feat.agg(
        n.alias("total_applications"),
        F.sum("TARGET").alias("default_count"),
        (n - F.sum("TARGET")).alias("non_default_count"),
        default_pct().alias("default_rate_pct"),
    )


def kpi_02_default_by_income_band(feat: DataFrame) -> DataFrame:
    return (feat.groupBy("income_band")
            .agg(F.count(F.lit(1)).alias("n"), default_pct().alias("default_rate_pct"))
            .orderBy("income_band"))


def kpi_03_default_by_credit_band(feat: DataFrame) -> DataFrame:
    return (feat.groupBy(band("AMT_CREDIT", CREDIT_EDGES, CREDIT_LABELS).alias("credit_band"))
            .agg(F.count(F.lit(1)).alias("n"), default_pct().alias("default_rate_pct"))
            .orderBy("credit_band"))


def kpi_04_default_by_burden_decile(feat: DataFrame, n: int = 10) -> DataFrame:
    scored = distributed_ntile(
        feat.where(F.col("annuity_to_credit_ratio").isNotNull())
        .select("SK_ID_CURR", "TARGET", "annuity_to_credit_ratio"),
        "annuity_to_credit_ratio", "SK_ID_CURR", n, "decile")
    return (scored.groupBy("decile")
            .agg(F.count(F.lit(1)).alias("n"), default_pct().alias("default_rate_pct"))
            .orderBy("decile"))


def kpi_05_default_by_age_band(feat: DataFrame) -> DataFrame:
    age_band = (F.floor(F.col("age_years") / F.lit(5)) * 5).cast("bigint")
    return (feat.where(F.col("age_years").isNotNull())
            .groupBy(age_band.alias("age_band_5y"))
            .agg(F.count(F.lit(1)).alias("customers_number"), default_pct().alias("default_rate_pct"))
            .orderBy("age_band_5y"))


def kpi_06_default_by_occupation(feat: DataFrame, min_count: int = 500) -> DataFrame:
    """HAVING ``count(*) >= min_count``; the reference uses 500 on 307,511 applications."""
    return (feat.groupBy("occupation_type_clean")
            .agg(F.count(F.lit(1)).alias("customers_number"), default_pct().alias("default_rate_pct"))
            .where(F.col("customers_number") >= min_count)
            .orderBy(F.col("default_rate_pct").desc_nulls_last()))
