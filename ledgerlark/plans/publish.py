"""Write, audit, publish: a table model is read only after its files were checked.

A model is written to a staging folder beside its destination, the audit reads
those files back, and only if it finds nothing is the folder renamed to the
destination (the version before it steps aside and is removed). A join that
fanned out, a lost row or a NULL key is therefore never published: the
destination keeps the last good version, and the rejected files stay in the
staging folder to be looked at.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.compat import count_if
from ..operators.features import INSTALMENT_KEYS


@dataclass(frozen=True)
class Contract:
    """What a written table must hold: one row per ``key``, and as many rows as the model ``spine``.

    A key part may be NULL only if it is a report's group (``nulls``).
    """

    key: tuple[str, ...]
    spine: str | None = None
    nulls: bool = False


CONTRACTS: dict[str, Contract] = {
    "bureau_balance_loan_summary": Contract(("SK_ID_BUREAU",)),
    "int_bureau_balance_summarized": Contract(("SK_ID_BUREAU",)),
    "int_bureau_enriched": Contract(("SK_ID_BUREAU",), "stg_bureau"),
    "int_installments_features": Contract(tuple(INSTALMENT_KEYS), nulls=True),
    "int_credit_card_features": Contract(("SK_ID_CURR",)),
    "mart_customer_credit_history": Contract(("SK_ID_CURR",)),
    "mart_target_kpi_analysis": Contract(("SK_ID_CURR",), "int_application_train_features"),
    "fct_ml_payment_behavior_features": Contract(("customer_id",), "stg_application_train"),
    "rpt_egitim_gelir_odeme": Contract(("egitim",), nulls=True),
    "rpt_gelir_dilimleri": Contract(("gelir_dilimi",)),
    "rpt_kredi_gelir_orani": Contract(("oran_grubu",), nulls=True),
    "rpt_yas_egitim_capraz": Contract(("yas_grubu", "egitim_bandi"), nulls=True),
    "rpt_yas_gelir_odeme": Contract(("yas_grubu",), nulls=True),
}


class AuditFailed(Exception):
    """A written table broke its contract; ``path`` holds the rejected files."""

    def __init__(self, model: str, path: str, findings: dict[str, int]) -> None:
        super().__init__(f"{model} is not published, see {path}: " + ", ".join(f"{k} {n}" for k, n in findings.items()))
        self.model, self.path, self.findings = model, path, findings


def audit(table: DataFrame, contract: Contract, spine_rows: int | None = None) -> dict[str, int]:
    """Counts of what is wrong with the table; empty when nothing is.

    One aggregate over the key columns: rows per key are counted map-side, so a
    key that a fanned-out join repeated a million times is one row per task.
    """
    keys = [F.col(k) for k in contract.key]
    null = F.lit(False)
    for k in keys:
        null = null | k.isNull()
    per_key = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    r = per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
        count_if(F.col("_rows") > 1).alias("repeated"),
        F.coalesce(F.sum(F.when(null, F.col("_rows"))), F.lit(0)).alias("nulls"),
    ).first()
    found = {"keys in several rows": r["repeated"], "rows with a NULL key": 0 if contract.nulls else r["nulls"]}
    if spine_rows is not None:
        found[f"rows more than the {spine_rows} expected"] = max(0, r["rows"] - spine_rows)
        found[f"rows fewer than the {spine_rows} expected"] = max(0, spine_rows - r["rows"])
    return {k: n for k, n in found.items() if n}


class _Files:
    """The shared file system of a path, as Spark sees it."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.fs = self.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.Path(path))

    def move(self, source: str, target: str) -> None:
        self.fs.mkdirs(self.Path(target).getParent())
        if not self.fs.rename(self.Path(source), self.Path(target)):
            raise OSError(f"cannot rename {source} to {target}")

    def remove(self, path: str) -> None:
        self.fs.delete(self.Path(path), True)


def publish(spark: SparkSession, model: str, root: str, write: Callable[[str], None], spine_rows: Callable[[], int] | None = None,
            contract: Contract | None = None) -> str:
    """Write ``model`` by ``write(folder)``, audit the files and publish them as ``{root}/{model}``; returns that path.

    Raises :class:`AuditFailed` and publishes nothing when the audit finds something.
    """
    root = root.rstrip("/")
    contract = contract or CONTRACTS[model]
    # names that begin with an underscore are no data to Spark's readers
    attempt = uuid.uuid4().hex[:12]
    staged, aside, target = f"{root}/_staged/{attempt}/{model}", f"{root}/_replaced/{attempt}/{model}", f"{root}/{model}"
    write(staged)
    found = audit(spark.read.parquet(staged), contract, spine_rows() if spine_rows else None)
    if found:
        raise AuditFailed(model, staged, found)
    files = _Files(spark, root)
    before = files.exists(target)
    if before:
        files.move(target, aside)
    try:
        files.move(staged, target)
    except Exception:
        if before:
            files.move(aside, target)
        raise
    if before:
        files.remove(f"{root}/_replaced/{attempt}")
    files.remove(f"{root}/_staged/{attempt}")
    return target


def audit_published(spark: SparkSession, root: str, spine_rows: Callable[[str], int], models: Sequence[str] = tuple(CONTRACTS)) -> dict[str, dict[str, int]]:
    """What is wrong with each table found under ``root``, from the files as they are now; models without a table are left out."""
    files = _Files(spark, root)
    out = {}
    for model in models:
        path = f"{root.rstrip('/')}/{model}"
        if files.exists(path):
            contract = CONTRACTS[model]
            out[model] = audit(spark.read.parquet(path), contract, spine_rows(contract.spine) if contract.spine else None)
    return out
