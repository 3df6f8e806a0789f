"""Credit source tables derived by Spark from the driver's test data.

``fixture_tables(spark, sf_dir)`` returns the eight credit tables, named like
the reference's raw tables, as lazy DataFrames: each view is built (and
analysed) only when first used, and Catalyst plans it together with the
query that reads it, so column pruning and filter pushdown reach the parquet
scans.  ``load_fixture_tables`` writes them once to the shared folder, the
way the reference's raw tables sit in the warehouse, and reads them back.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import input_bytes
from .fixture_views import VIEWS, ViewSpec

# Driver tables read by the fixture views (TESTDATA.md).
DRIVER_TABLES = ("customer", "supplier", "orders", "lineitem", "events")


#: Bytes of the joined files that one task takes; a task's sorts and the hash tables after them need up to some 100 times as much.
TASK_BYTES = 8 * 1024 * 1024
#: Joins of fewer tasks are left to Spark, which broadcasts the smaller side.
LEAST_TASKS = 16


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table with its own footer schema.

    One footer read per table and session (the views are cached); the view
    expressions and ``_with_order_day`` accept either integer width and
    either timestamp flavour, so a differently typed file still works.
    """
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _with_order_day(orders: DataFrame) -> DataFrame:
    """Add ``_o_day`` (DATE of ``o_orderdate``) independent of the session time zone.

    The test data stores wall-clock timestamps; read as TIMESTAMP_NTZ the cast
    is exact, read as an instant we take the UTC calendar day.
    """
    dtype = orders.schema["o_orderdate"].dataType
    if isinstance(dtype, T.TimestampType):
        day = F.date_from_unix_date(
            F.floor(F.unix_micros("o_orderdate") / F.lit(86_400_000_000)).cast("int"))
    else:
        day = F.col("o_orderdate").cast("date")
    return orders.withColumn("_o_day", day)


def join_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks for the join of lineitem and orders by the bytes of their files; 0 leaves the number to Spark."""
    if not hasattr(spark, "_jvm"):  # a Spark Connect session sees no file sizes
        return 0
    n = -(-input_bytes(spark, [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ("lineitem", "orders")]) // TASK_BYTES)
    return n if n >= LEAST_TASKS else 0


def build_view(spec: ViewSpec, raw: Mapping[str, DataFrame], tasks: Callable[[], int] = lambda: 0) -> DataFrame:
    """``tasks`` tells into how many tasks a join with orders is dealt; 0 leaves it to Spark."""
    base = raw[spec.base]
    if spec.base == "orders":
        base = _with_order_day(base)
    if spec.join_orders:
        orders = _with_order_day(raw["orders"])
        if n := tasks():
            base, orders = base.repartition(n, "l_orderkey"), orders.repartition(n, "o_orderkey")
        base = base.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if spec.where:
        base = base.where(spec.where)
    df = base.selectExpr(*[f"{e} AS {n}" for n, e in spec.exprs("spark")])
    return df.distinct() if spec.distinct else df


class LazyTables(Mapping[str, DataFrame]):
    """Name -> DataFrame, each built on first access and then reused.

    ``by_loan`` has the same tables for roll-ups by loan. They need no exchange
    of their own after the join with orders, so its task holds the sorts of both
    sides and the hash tables of every roll-up at once: what AQE coalesces by
    shuffle bytes alone is too much for one task, and there the join is dealt by
    :func:`join_tasks`. For all else Spark may still split a skewed order.
    """

    def __init__(self, builders: Mapping[str, object], by_loan: LazyTables | None = None) -> None:
        self.by_loan = by_loan or self
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}
        self._lock = threading.Lock()

    def __getitem__(self, name: str) -> DataFrame:
        with self._lock:
            if name not in self._built:
                self._built[name] = self._builders[name]()  # type: ignore[operator]
            return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


_CACHE: dict[tuple[str, str], LazyTables] = {}


def _session_key(spark: SparkSession) -> str:
    try:
        return str(spark.sparkContext.applicationId)
    except Exception:  # noqa: BLE001 -- a Spark Connect session has no SparkContext
        return f"session-{id(spark)}"


def fixture_tables(spark: SparkSession, sf_dir: str) -> LazyTables:
    """All eight credit source tables over ``sf_dir`` (lazy; cached per session and folder)."""
    key = (_session_key(spark), sf_dir.rstrip("/"))
    if key not in _CACHE:
        raw = LazyTables({t: (lambda t=t: _read(spark, sf_dir, t)) for t in DRIVER_TABLES})
        by_loan = LazyTables({
            name: (lambda spec=spec: build_view(spec, raw, lambda: join_tasks(spark, sf_dir)))
            for name, spec in VIEWS.items()})
        _CACHE[key] = LazyTables({
            name: (lambda spec=spec: build_view(spec, raw)) for name, spec in VIEWS.items()}, by_loan)
    return _CACHE[key]


def load_fixture_tables(spark: SparkSession, sf_dir: str, dest: str,
                        num_files: int | None = None) -> LazyTables:
    """Write every credit table once under ``dest`` (shared storage) and read them back.

    The driver's files hold one row group each, so a scan of them is one task;
    the loaded tables are split into ``num_files`` files (default: the
    session's shuffle partition count) as a warehouse table would be.
    """
    views = fixture_tables(spark, sf_dir)
    n = num_files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name in VIEWS:
        views[name].repartition(n).write.mode("overwrite").parquet(f"{dest.rstrip('/')}/{name}")
    return LazyTables({name: (lambda name=name: spark.read.parquet(f"{dest.rstrip('/')}/{name}"))
                       for name in VIEWS})
