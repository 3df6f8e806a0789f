"""Incremental staging of raw files as they land (Structured Streaming).

Staging is row-for-row (no grain change, no state), so the very same
staging functions apply to a file stream: each micro-batch of newly arrived
raw files is cleaned and appended to the staged table.  The raw schema is
explicit (no inference on a stream), progress lives in the checkpoint
location on shared storage, and the file sink commits each batch exactly
once, so a restarted or retried query neither loses nor repeats rows.

The aggregating models are not streamed: their semantics (e.g. a loan's
whole monthly history) are defined over the complete table, which the batch
catalog rebuilds from the staged output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import staging as st
from ..sources.raw import file_schema

STAGERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "application_train": st.stg_application_train_clean,
    "bureau": st.stg_bureau,
    "bureau_balance": st.stg_bureau_balance,
    "credit_card_balance": st.stg_credit_card_balance,
    "installments_payments": st.stg_installments_payments,
    "POS_CASH_balance": st.stg_pos_cash_balance,
    "previous_application": st.stg_previous_application,
}


def raw_stream(spark: SparkSession, table: str, source_dir: str, fmt: str = "parquet",
               max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of raw rows from new files under ``source_dir``, bound by column name.

    The files present at the start name the columns; a bad CSV row or a file
    with another header fails the query instead of giving NULLs.
    """
    r = spark.readStream.schema(file_schema(spark, source_dir, table, fmt)).format(fmt)
    if fmt == "csv":
        r = (r.option("header", True).option("mode", "FAILFAST").option("enforceSchema", False)
             .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(source_dir)


def stage_stream(spark: SparkSession, table: str, source_dir: str, sink_dir: str, checkpoint_dir: str,
                 fmt: str = "parquet", available_now: bool = True) -> StreamingQuery:
    """Start the incremental staging query for ``table``; returns the running query.

    ``available_now`` processes every file present now, in bounded batches,
    then stops (a scheduled incremental load); otherwise it keeps running.
    """
    staged = STAGERS[table](raw_stream(spark, table, source_dir, fmt))
    w = (staged.writeStream.format("parquet").outputMode("append")
         .option("path", sink_dir).option("checkpointLocation", checkpoint_dir))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
