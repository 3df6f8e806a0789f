"""Loaders for the raw credit tables as they arrive (CSV or parquet files).

The reference declares no column types (schemas are inferred at load); here
every table gets an explicit ``StructType`` so a 100 TB load never runs schema
inference and the types downstream operators rely on are fixed.  Names are
spelled as the source spells them (``POS_CASH_balance`` keeps its case).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_L, _D, _S, _B = T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType()


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


SCHEMAS: dict[str, T.StructType] = {
    "application_train": _schema(
        ("SK_ID_CURR", _L), ("TARGET", _L), ("EXT_SOURCE_1", _D), ("EXT_SOURCE_2", _D),
        ("EXT_SOURCE_3", _D), ("AMT_INCOME_TOTAL", _D), ("AMT_CREDIT", _D), ("AMT_ANNUITY", _D),
        ("DAYS_BIRTH", _L), ("DAYS_EMPLOYED", _L), ("OCCUPATION_TYPE", _S),
        ("NAME_EDUCATION_TYPE", _S)),
    "application_test": _schema(("SK_ID_CURR", _L)),
    "bureau": _schema(
        ("SK_ID_CURR", _L), ("SK_ID_BUREAU", _L), ("CREDIT_ACTIVE", _S), ("CREDIT_CURRENCY", _S),
        ("DAYS_CREDIT", _L), ("CREDIT_DAY_OVERDUE", _L), ("DAYS_CREDIT_ENDDATE", _L),
        ("DAYS_ENDDATE_FACT", _L), ("AMT_CREDIT_MAX_OVERDUE", _D), ("CNT_CREDIT_PROLONG", _L),
        ("AMT_CREDIT_SUM", _D), ("AMT_CREDIT_SUM_DEBT", _D), ("AMT_CREDIT_SUM_LIMIT", _D),
        ("AMT_CREDIT_SUM_OVERDUE", _D), ("CREDIT_TYPE", _S), ("DAYS_CREDIT_UPDATE", _L),
        ("AMT_ANNUITY", _D)),
    "bureau_balance": _schema(("SK_ID_BUREAU", _L), ("MONTHS_BALANCE", _L), ("STATUS", _S)),
    "installments_payments": _schema(
        ("SK_ID_CURR", _L), ("SK_ID_PREV", _L), ("NUM_INSTALMENT_VERSION", _D),
        ("NUM_INSTALMENT_NUMBER", _L), ("DAYS_INSTALMENT", _D), ("DAYS_ENTRY_PAYMENT", _D),
        ("AMT_INSTALMENT", _D), ("AMT_PAYMENT", _D)),
    "credit_card_balance": _schema(
        ("SK_ID_CURR", _L), ("SK_ID_PREV", _L), ("MONTHS_BALANCE", _L), ("AMT_BALANCE", _D),
        ("AMT_CREDIT_LIMIT_ACTUAL", _L), ("AMT_INST_MIN_REGULARITY", _D),
        ("AMT_PAYMENT_CURRENT", _D), ("AMT_PAYMENT_TOTAL_CURRENT", _D),
        ("NAME_CONTRACT_STATUS", _S), ("SK_DPD", _L), ("SK_DPD_DEF", _L)),
    "POS_CASH_balance": _schema(
        ("SK_ID_PREV", _L), ("SK_ID_CURR", _L), ("MONTHS_BALANCE", _L), ("CNT_INSTALMENT", _D),
        ("CNT_INSTALMENT_FUTURE", _D), ("NAME_CONTRACT_STATUS", _S), ("SK_DPD", _L),
        ("SK_DPD_DEF", _L)),
    "previous_application": _schema(
        ("SK_ID_PREV", _L), ("SK_ID_CURR", _L), ("NAME_CONTRACT_TYPE", _S),
        ("NAME_CONTRACT_STATUS", _S), ("NAME_PAYMENT_TYPE", _S), ("CODE_REJECT_REASON", _S),
        ("NAME_CLIENT_TYPE", _S), ("NAME_PORTFOLIO", _S), ("NAME_PRODUCT_TYPE", _S),
        ("PRODUCT_COMBINATION", _S), ("NAME_YIELD_GROUP", _S), ("AMT_ANNUITY", _D),
        ("AMT_APPLICATION", _D), ("AMT_CREDIT", _D), ("AMT_DOWN_PAYMENT", _D),
        ("AMT_GOODS_PRICE", _D), ("RATE_DOWN_PAYMENT", _D), ("RATE_INTEREST_PRIMARY", _D),
        ("RATE_INTEREST_PRIVILEGED", _D), ("WEEKDAY_APPR_PROCESS_START", _S),
        ("HOUR_APPR_PROCESS_START", _L), ("DAYS_DECISION", _L), ("DAYS_FIRST_DRAWING", _D),
        ("DAYS_FIRST_DUE", _D), ("DAYS_LAST_DUE_1ST_VERSION", _D), ("DAYS_LAST_DUE", _D),
        ("DAYS_TERMINATION", _D), ("NAME_TYPE_SUITE", _S), ("NAME_GOODS_CATEGORY", _S),
        ("CHANNEL_TYPE", _S), ("SELLERPLACE_AREA", _L), ("NAME_SELLER_INDUSTRY", _S),
        ("CNT_PAYMENT", _D), ("FLAG_LAST_APPL_PER_CONTRACT", _B), ("NFLAG_LAST_APPL_IN_DAY", _L),
        ("NFLAG_INSURED_ON_APPROVAL", _D)),
}


def file_schema(spark: SparkSession, path: str, name: str, fmt: str) -> T.StructType:
    """Schema of the files at ``path`` by column name: declared types for the columns of
    ``SCHEMAS[name]``, what the file says (CSV: text) for all others.

    Raises when a declared column is missing or a name comes twice, so that
    nothing is ever bound by position.
    """
    declared = {f.name.lower(): f for f in SCHEMAS[name].fields}
    if fmt == "csv":  # names from the header row; nothing is inferred
        found = [T.StructField(c, _S) for c in spark.read.option("header", True).csv(path).columns]
    else:
        found = spark.read.format(fmt).load(path).schema.fields
    names = [f.name.lower() for f in found]
    missing = [f.name for key, f in declared.items() if key not in names]
    if missing:
        raise ValueError(f"{name}: {path} has no column {', '.join(missing)}")
    if len(set(names)) < len(names):
        raise ValueError(f"{name}: {path} names a column twice")
    return T.StructType([declared.get(f.name.lower(), f) for f in found])


#: Name of the column that holds a record which could not be read.
BAD_RECORD = "_bad_record"


def _read_csv(spark: SparkSession, path: str, schema: T.StructType, mode: str) -> DataFrame:
    """CSV by header names; the fields of a record are counted whatever is selected."""
    return (spark.read.schema(schema).option("header", True).option("mode", mode)
            .option("columnNameOfCorruptRecord", BAD_RECORD).option("columnPruning", False)
            .option("enforceSchema", False)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .csv(path))


def rejected_records(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``table_name, file, record`` of the CSV records of one raw table that cannot be read.

    A record is bad when it has more or fewer fields than the header or a field
    that is not of the declared type. ``load_table(..., bad_rows="reject")``
    reads exactly the others.
    """
    path = f"{root.rstrip('/')}/{name}"
    schema = file_schema(spark, path, name, "csv").add(BAD_RECORD, _S)
    read = F.length(F.concat_ws("", *[F.col(f.name).cast("string") for f in SCHEMAS[name].fields])) >= 0
    bad = _read_csv(spark, path, schema, "PERMISSIVE").where(F.col(BAD_RECORD).isNotNull() & read)
    return bad.select(F.lit(name).alias("table_name"), F.col("_metadata.file_path").alias("file"), F.col(BAD_RECORD).alias("record"))


def write_rejects(spark: SparkSession, root: str, names: Sequence[str], dest: str) -> dict[str, int]:
    """Write the rejected records of the tables to ``dest`` (one folder per table) and return their counts, from what was written."""
    out = {}
    for name in names:
        path = f"{dest.rstrip('/')}/{name}"
        rejects = rejected_records(spark, root, name)
        rejects.write.mode("overwrite").parquet(path)
        out[name] = spark.read.schema(rejects.schema).parquet(path).count()
    return out


def load_table(spark: SparkSession, root: str, name: str, fmt: str = "parquet", bad_rows: str = "fail") -> DataFrame:
    """Read one raw table from ``{root}/{name}`` (a file or a directory of files).

    Columns are bound by name, in whatever order the files have them: the
    declared ones come first with their declared types, all others follow
    unchanged, and a missing one raises. CSV files need a header row that is
    the same in every file; values keep their leading and trailing white space
    (the audits look for it). A CSV record that cannot be read ends the query
    that meets it (``bad_rows="fail"``) or is left out (``"reject"``, see
    :func:`rejected_records`).
    """
    if bad_rows not in ("fail", "reject"):
        raise ValueError(f"bad_rows is fail or reject, not {bad_rows}")
    path = f"{root.rstrip('/')}/{name}"
    schema = file_schema(spark, path, name, fmt)
    if fmt == "csv":
        if bad_rows == "fail":
            df = _read_csv(spark, path, schema, "FAILFAST")
        else:
            df = _read_csv(spark, path, T.StructType([*schema.fields, T.StructField(BAD_RECORD, _S)]), "PERMISSIVE")
            # only the columns that a query uses are parsed; all typed ones are used here, so that a
            # record is good or bad for every query alike
            read = F.length(F.concat_ws("", *[F.col(f.name).cast("string") for f in SCHEMAS[name].fields])) >= 0
            df = df.where(F.col(BAD_RECORD).isNull() & read).drop(BAD_RECORD)
    else:
        df = spark.read.format(fmt).load(path)
    own = [f.name for f in SCHEMAS[name].fields]
    rest = [f.name for f in schema.fields if f.name not in own]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[name].fields], *rest)


def load_tables(spark: SparkSession, root: str, fmt: str = "parquet",
                names: tuple[str, ...] | None = None, bad_rows: str = "fail") -> dict[str, DataFrame]:
    """All (or the named) raw tables under ``root``; lazily, nothing is scanned."""
    return {n: load_table(spark, root, n, fmt, bad_rows) for n in (names or tuple(SCHEMAS))}
