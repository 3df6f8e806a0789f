"""Skew probe: the bureau lineage on generated tables where one key holds a third of the rows.

    python tools/scale_probe.py [monthly_rows] [loans]
    python tools/scale_probe.py ntile [rows]

Generates (with ``spark.range``, not registered as a query) a monthly table
where one loan holds a third of the rows, and a loan table where one customer
holds a third of the loans, then runs loan summary -> enriched loans ->
customer mart end to end.  Task times per stage come from Spark's event log
(written to a scratch folder): a hot key shows up as one task far slower
than the median of its stage.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ledgerlark.operators import features as ft  # noqa: E402
from ledgerlark.operators import marts as mt  # noqa: E402
from ledgerlark.operators import staging as st  # noqa: E402


def _session(logdir: str) -> SparkSession:
    spark = (SparkSession.builder.master("local[8]").appName("scale-probe")
             .config("spark.sql.shuffle.partitions", "64")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
             # small advisory size so the reduce stages keep many tasks and a hot task would show
             .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(4 * 1024 * 1024))
             .config("spark.sql.codegen.hugeMethodLimit", "8000")
             .config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g")
             .config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", logdir)
             .config("spark.eventLog.compress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _stage_times(logdir: str) -> list[dict]:
    stages: dict[tuple, list[float]] = {}
    for path in [p for p in glob.glob(f"{logdir}/**/*", recursive=True) if os.path.isfile(p)]:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                if ev.get("Event") == "SparkListenerTaskEnd" and ev.get("Task Info"):
                    ti = ev["Task Info"]
                    key = (ev["Stage ID"], ev["Stage Attempt ID"])
                    stages.setdefault(key, []).append((ti["Finish Time"] - ti["Launch Time"]) / 1000)
    return [
        {"stage": k[0], "tasks": len(v), "max_task_s": round(max(v), 2),
         "median_task_s": round(statistics.median(v), 2),
         "max_over_median": round(max(v) / max(statistics.median(v), 1e-3), 2)}
        for k, v in sorted(stages.items()) if len(v) >= 2
    ]


def ntile_probe(rows: int) -> None:
    """Deciles over a column where one value and the NULLs each hold a third of the rows."""
    from ledgerlark.operators.ntile import distributed_ntile

    logdir = tempfile.mkdtemp(prefix="ledgerlark-eventlog-", dir="/tmp")
    spark = _session(logdir)
    df = spark.range(rows, numPartitions=32).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise((F.col("id") * 7919 % 100_003).cast("double")).alias("x"))
    t0 = time.perf_counter()
    counts = {r["b"]: r["count"] for r in distributed_ntile(df, "x", "id", 10, "b")
              .groupBy("b").count().collect()}
    elapsed = time.perf_counter() - t0
    spark.stop()
    print(json.dumps({"rows": rows, "hot_value_rows": rows // 3, "null_rows": rows // 3,
                      "seconds": round(elapsed, 1), "bucket_sizes": [counts[b] for b in sorted(counts)],
                      "stages": _stage_times(logdir), "event_log": logdir}))


def main() -> None:
    if len(sys.argv) > 1 and sys.argv[1] == "ntile":
        ntile_probe(int(sys.argv[2]) if len(sys.argv) > 2 else 30_000_000)
        return
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 30_000_000
    loans = int(sys.argv[2]) if len(sys.argv) > 2 else 3_000_000
    logdir = tempfile.mkdtemp(prefix="ledgerlark-eventlog-", dir="/tmp")
    spark = _session(logdir)
    status = F.element_at(F.array(*[F.lit(s) for s in ["C", "C", "0", "X", "1", "2", "3", "4", "5"]]),
                          (F.col("id") % 9 + 1).cast("int"))
    balance = spark.range(rows, numPartitions=32).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % loans).alias("SK_ID_BUREAU"),
        (-(F.col("id") % 97)).alias("MONTHS_BALANCE"), status.alias("STATUS"))
    bureau = spark.range(loans, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 100_000 + 2).alias("SK_ID_CURR"),
        F.col("id").alias("SK_ID_BUREAU"),
        F.element_at(F.array(F.lit("Active"), F.lit("Closed"), F.lit("Sold")), (F.col("id") % 3 + 1).cast("int"))
        .alias("CREDIT_ACTIVE"),
        F.when(F.col("id") % 50 == 0, F.lit("currency 2")).otherwise(F.lit("currency 1")).alias("CREDIT_CURRENCY"),
        (-(F.col("id") % 3000)).alias("DAYS_CREDIT"), (F.col("id") % 5).alias("CREDIT_DAY_OVERDUE"),
        (F.col("id") % 900).alias("DAYS_CREDIT_ENDDATE"), F.lit(None).cast("bigint").alias("DAYS_ENDDATE_FACT"),
        (F.col("id") % 1000).cast("double").alias("AMT_CREDIT_MAX_OVERDUE"), F.lit(0).cast("bigint").alias("CNT_CREDIT_PROLONG"),
        (F.col("id") % 100000 / 100).alias("AMT_CREDIT_SUM"), (F.col("id") % 70000 / 100 - 50).alias("AMT_CREDIT_SUM_DEBT"),
        F.lit(0.0).alias("AMT_CREDIT_SUM_LIMIT"), F.lit(0.0).alias("AMT_CREDIT_SUM_OVERDUE"),
        F.element_at(F.array(F.lit("Consumer credit"), F.lit("Credit card")), (F.col("id") % 2 + 1).cast("int"))
        .alias("CREDIT_TYPE"), (-(F.col("id") % 700)).alias("DAYS_CREDIT_UPDATE"), F.lit(None).cast("double").alias("AMT_ANNUITY"))

    summary = ft.bureau_balance_loan_summary(st.stg_bureau_balance(balance))
    mart = mt.mart_customer_credit_history(ft.int_bureau_enriched(st.stg_bureau(bureau), summary))
    t0 = time.perf_counter()
    hot = mart.where("SK_ID_CURR = 1").select("total_bureau_loans", "total_late_months").first()
    n = mart.count()
    elapsed = time.perf_counter() - t0
    spark.stop()

    per_stage = _stage_times(logdir)
    print(json.dumps({
        "monthly_rows": rows, "loans": loans, "hot_loan_rows": rows // 3 + 1, "hot_customer_loans": hot[0],
        "customers": n, "seconds": round(elapsed, 1),

        "stages": per_stage, "event_log": logdir,
    }))


if __name__ == "__main__":
    main()
