"""Command line: build the table models and run the data checks over raw tables.

    python -m ledgerlark build  --raw ROOT [--fmt parquet|csv] [--out DIR]
    python -m ledgerlark check  --raw ROOT [--fmt parquet|csv] [--built DIR]
    python -m ledgerlark query  --raw ROOT KEY [KEY ...] [--out DIR]

``--raw`` holds one folder (or file) per raw table, named as the source names
it (``bureau``, ``bureau_balance``, ``POS_CASH_balance``, ...).  The session
is whatever ``spark-submit`` provides; table writes default to the cluster's
``spark.checkpoint.dir``.  ``build`` audits the files of each table before it
publishes them and stops at a table that breaks its contract; ``check`` runs the
data checks and, with ``--built``, the same audits on the tables as they lie
there.  Both exit non-zero when something fails.  ``--rejects DIR`` loads the
good rows of CSV files, writes the others to DIR and prints their counts;
without it, a bad row ends the run.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .plans.catalog import Catalog
from .plans.publish import AuditFailed, audit_published
from .plans.registry import QUERIES
from .plans.sinks import build, write_table
from .sources.raw import load_tables, write_rejects

CHECK_KEYS = ["check_unique", "check_not_null", "check_accepted_values", "check_accepted_range",
              "check_join_preserves_rows"]


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="ledgerlark", description="Credit-history models, audits and checks on Spark.")
    ap.add_argument("command", choices=["build", "check", "query"],
                    help="build: write the table models; check: run the data checks; query: run query keys")
    ap.add_argument("keys", nargs="*", help="query keys (for 'query'), e.g. mart_customer_credit_history")
    ap.add_argument("--raw", required=True, help="folder holding one sub-folder or file per raw table")
    ap.add_argument("--fmt", default="parquet", help="raw table format: parquet (default) or csv")
    ap.add_argument("--out", default=None, help="output folder (default: under spark.checkpoint.dir)")
    ap.add_argument("--built", default=None, help="check: folder of tables written by build, audited too")
    ap.add_argument("--rejects", default=None, help="CSV: write bad rows to this folder and load the others")
    ap.add_argument("--auto-size", action="store_true",
                    help="size shuffle partitions and scan splits from the raw input volume")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.getOrCreate()
    if args.auto_size:
        from .session import apply_scale_settings
        for k, v in apply_scale_settings(spark, [args.raw]).items():
            print(f"# {k}={v}")
    rejecting = args.rejects is not None and args.fmt == "csv"
    tables = load_tables(spark, args.raw, args.fmt, bad_rows="reject" if rejecting else "fail")
    if rejecting:
        for name, n in write_rejects(spark, args.raw, tuple(tables), args.rejects).items():
            print(f"REJECTED\t{name}\t{n}")
    cat = Catalog(tables, materialize=args.command == "build", spark=spark)

    if args.command == "build":
        try:
            for name, path in build(cat, args.out).items():
                print(f"{name}\t{path}")
        except AuditFailed as e:
            print(f"FAIL\t{e}")
            return 1
        return 0
    if args.command == "check":
        failed = 0
        for key in CHECK_KEYS:
            for r in QUERIES[key](cat).collect():  # a handful of rows per check
                status = "PASS" if r.failures == 0 else "FAIL"
                failed += r.failures != 0
                print(f"{status}\t{key}\t{r.model}.{r.column_name}\t{r.failures}")
        if args.built:
            found = audit_published(spark, args.built, lambda spine: getattr(cat, spine).count())
            if not found:
                print(f"FAIL\tpublished\tno table in {args.built}")
            for model, wrong in found.items():
                failed += bool(wrong)
                print(f"{'FAIL' if wrong else 'PASS'}\tpublished\t{model}\t{sum(wrong.values())}" + "".join(f"\t{k}" for k in wrong))
            failed += not found
        return 1 if failed else 0
    for key in args.keys:
        df = QUERIES[key](cat)
        if args.out:
            write_table(df, f"{args.out.rstrip('/')}/{key}")
        else:
            df.show(50, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
