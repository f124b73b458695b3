"""bench.py prints exactly one JSON line with the agreed keys (smoke run on sf0.001)."""

import json
import os
import subprocess
import sys

from tests.conftest import ROOT, SF001


def test_bench_smoke():
    env = dict(os.environ, BENCH_SF_DIR=SF001, BENCH_RUNS="1", BENCH_CPUS="2")
    proc = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True, text=True, timeout=900
    )
    assert proc.returncode == 0, proc.stderr[-2000:]
    lines = [line for line in proc.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert out["unit"] == "sec" and out["sf"] == "0.001" and out["value"] > 0
    assert {"pipeline", "q1_top_complaints_by_borough", "q9_complaint_resolution_by_borough"} <= set(out["queries"])
