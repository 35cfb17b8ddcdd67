"""bench.py prints exactly one JSON line in the agreed shape."""

from __future__ import annotations

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(small_dir):
    env = dict(os.environ, BENCH_SF_DIR=small_dir, BENCH_CPUS="2", BENCH_RUNS="1",
               BENCH_QUERIES="items_ordered,spend_by_customer", BENCH_DRIVER_MEMORY="1g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True).stdout
    lines = [line for line in out.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result["queries"]) == {"items_ordered", "spend_by_customer"}
    assert abs(result["value"] - sum(result["queries"].values())) < 1e-2
