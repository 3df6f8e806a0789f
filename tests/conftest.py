from __future__ import annotations

import os
import sys
import tempfile

import pytest

_HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(_HERE), _HERE]  # the repository, and the tests' own paths.py


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[4]").appName("ledgerlark-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlark-test-ckpt-"))
    yield s
    s.stop()
