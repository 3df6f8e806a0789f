"""Sinks: table writes, clustered tables, and a whole-DAG build.

``write_table`` is the reference's ``materialized='table'``;
``cluster_by`` is its ``cluster_by=[...]`` (``fct_ml_payment_behavior_features``):
rows are range-partitioned on the key and sorted inside each file, so files
cover key ranges that meet in one key at most and parquet min/max statistics let
a reader skip files for a key lookup, as a clustered warehouse table does. A key
that holds more rows than a file spans several files of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import input_bytes
from .catalog import Catalog, shared_dir
from .publish import CONTRACTS, publish

#: Size of a clustered table's files.
FILE_BYTES = 256 * 1024 * 1024

# Models written by ``build``, with their clustering keys (if any).
BUILD_MODELS: dict[str, Sequence[str]] = {
    "int_bureau_balance_summarized": (),
    "int_bureau_enriched": (),
    "int_installments_features": (),
    "int_credit_card_features": (),
    "mart_customer_credit_history": (),
    "mart_target_kpi_analysis": (),
    "fct_ml_payment_behavior_features": ("customer_id",),
    "rpt_egitim_gelir_odeme": (),
    "rpt_gelir_dilimleri": (),
    "rpt_kredi_gelir_orani": (),
    "rpt_yas_egitim_capraz": (),
    "rpt_yas_gelir_odeme": (),
}


def write_table(df: DataFrame, path: str, cluster_by: Sequence[str] = (), num_files: int | None = None,
                fmt: str = "parquet", mode: str = "overwrite", file_bytes: int = FILE_BYTES) -> None:
    """Write ``df`` as a table at ``path``; optionally clustered by ``cluster_by``.

    Without clustering the write keeps the plan's own partitioning (no extra
    shuffle).  With clustering, ``num_files`` files are sorted by the key; by
    default the rows are written as they come first, and the bytes of those
    files tell how many files of ``file_bytes`` the table needs.
    """
    if cluster_by and not num_files:
        spark, plain = df.sparkSession, f"{shared_dir(df.sparkSession)}/ledgerlark-unclustered/{uuid.uuid4().hex}"
        df.write.format(fmt).save(plain)
        num_files = max(1, -(-input_bytes(spark, [plain]) // file_bytes))
        df = spark.read.format(fmt).schema(df.schema).load(plain)
    if cluster_by:
        # the row's hash splits a key that holds more rows than a file between several ranges
        spread = [F.col(c) for c in cluster_by] + [F.xxhash64(*df.columns)]
        df = df.repartitionByRange(num_files, *spread).sortWithinPartitions(*cluster_by)
    elif num_files:
        df = df.coalesce(num_files)
    df.write.format(fmt).mode(mode).save(path)


def build(catalog: Catalog, dest: str | None = None) -> dict[str, str]:
    """Write, audit and publish every table model of the DAG (the equivalent of a full ``run``).

    A model whose written files break its contract (:mod:`publish`) ends the
    build with ``AuditFailed``: neither it nor what is built on it is published.

    ``dest`` defaults to a folder under the shared checkpoint directory.
    A model that the catalog materialises itself, on the way to another, is
    written once, to the same folder. Returns model name -> path.
    """
    root = (dest or f"{shared_dir(catalog.spark)}/ledgerlark-build/{catalog.run_id}").rstrip("/")
    if catalog.materialize and not catalog.written:
        catalog.dest = root
    out = {}
    for name, keys in BUILD_MODELS.items():
        path = f"{root}/{name}"
        model = getattr(catalog, name)
        if catalog.written.get(name) != path:
            df = model() if callable(model) else model
            publish(catalog.spark, name, root, lambda to, df=df, keys=keys: write_table(df, to, cluster_by=keys),
                    catalog.spine_rows(CONTRACTS[name].spine))
        out[name] = path
    return out
