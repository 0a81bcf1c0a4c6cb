"""bench.py prints exactly one JSON line in the driver's format."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from conftest import SF

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(
        os.environ,
        BENCH_SF_DIR=f"{SF}/sf0.001",
        BENCH_CPUS="2",
        BENCH_QUERIES="pair_count,class_count,kcenter_centers",
        BENCH_WARMUP_DIR="",
        BENCH_DRIVER_MEMORY="2g",
    )
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")],
        env=env,
        capture_output=True,
        text=True,
        timeout=600,
        check=True,
    ).stdout
    lines = [line for line in out.splitlines() if line.strip()]
    assert len(lines) == 1
    data = json.loads(lines[0])
    assert data["unit"] == "sec" and data["sf"] == 0.001
    assert set(data["queries"]) == {"pair_count", "class_count", "kcenter_centers"}
    assert abs(data["value"] - sum(data["queries"].values())) < 1e-6
