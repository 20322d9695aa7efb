"""bench.py prints one JSON line in the driver's format."""

import json
import os
import subprocess
import sys
from pathlib import Path

from tests.conftest import SF_SMALL

ROOT = Path(__file__).resolve().parents[1]


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_RUNS="1", BENCH_CPUS="2",
               BENCH_QUERIES="q20_union_filter,q24_observed_values")
    out = subprocess.run([sys.executable, str(ROOT / "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    doc = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(doc)
    assert doc["unit"] == "sec" and doc["sf"] == 0.001
    assert set(doc["queries"]) == {"q20_union_filter", "q24_observed_values"}
    assert abs(doc["value"] - sum(doc["queries"].values())) < 1e-6
