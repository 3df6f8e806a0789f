"""Session settings used by tests and the bench (a cluster brings its own)."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerlark") -> SparkSession:
    """A local session with AQE on, UI off, UTC, and a scratch checkpoint folder.

    AQE coalesces shuffle partitions toward the advisory size rather than
    keeping many small ones for parallelism (``parallelismFirst=false``), as
    recommended for shared clusters.

    The checkpoint folder is set only when the session has none, as a
    cluster configures ``spark.checkpoint.dir`` to shared storage itself.
    """
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.parallelismFirst",
                 os.environ.get("LEDGERLARK_PARALLELISM_FIRST", "false"))
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         # HotSpot does not JIT-compile methods over 8000 bytes: fall back rather than interpret
         .config("spark.sql.codegen.hugeMethodLimit", os.environ.get("LEDGERLARK_HUGE_METHOD_LIMIT", "8000"))
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.driver.memory", os.environ.get("LEDGERLARK_DRIVER_MEMORY", "8g"))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a scratch one only if unset.

    A scratch folder on this machine is only acceptable in local mode; on a
    cluster the shared folder must be configured (``spark.checkpoint.dir``).
    """
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on a cluster")
        conf = tempfile.mkdtemp(prefix="ledgerlark-ckpt-")
    spark.sparkContext.setCheckpointDir(conf)
    return spark.sparkContext.getCheckpointDir() or conf


PARTITION_BYTES = 256 * 1024 * 1024


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files under ``paths`` (file-system metadata only, no data read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            total += fs.getContentSummary(path).getLength()
    return total


def scale_settings(total_input_bytes: int, partition_bytes: int = PARTITION_BYTES) -> dict[str, str]:
    """Shuffle and scan sizes for an input of ``total_input_bytes``.

    Shuffle partitions start at about one per ``partition_bytes`` of input
    (so a partition fits an executor's memory without spilling), and AQE
    coalesces the small ones at run time toward the same advisory size.
    """
    n = max(200, -(-total_input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.codegen.hugeMethodLimit": "8000",
    }


def apply_scale_settings(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """Size the session for the raw tables under ``paths``; returns what was set."""
    settings = scale_settings(input_bytes(spark, paths))
    for k, v in settings.items():
        spark.conf.set(k, v)
    return settings
