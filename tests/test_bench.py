"""bench.py prints one JSON line in the driver's format (run on two keys at sf0.001)."""

from __future__ import annotations

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_json_contract():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES="kpi_01_default_rate,rpt_gelir_dilimleri", LEDGERLARK_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True).stdout.strip().splitlines()
    rec = json.loads(out[-1])
    assert rec["unit"] == "sec" and rec["metric"]
    assert set(rec["queries"]) == {"kpi_01_default_rate", "rpt_gelir_dilimleri"}
    assert abs(rec["value"] - sum(rec["queries"].values())) < 1e-6
    assert rec["sf"] == 0.001
