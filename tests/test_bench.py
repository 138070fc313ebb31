"""bench.py prints one JSON line in the driver's format."""

from __future__ import annotations

import json
import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_bench_prints_one_json_line(tmp_dir):
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2")
    env["SPARK_LOCAL_DIRS"] = tmp_dir
    out = subprocess.run(
        [sys.executable, str(ROOT / "bench.py"), "consumption_by_type", "gold_5min_stream"],
        capture_output=True, text=True, env=env, timeout=600, check=True,
    ).stdout.strip().splitlines()
    assert len(out) == 1
    result = json.loads(out[0])
    assert result["unit"] == "sec" and result["sf"] == "0.001"
    assert set(result["queries"]) == {"consumption_by_type", "gold_5min_stream"}
    assert result["value"] == round(sum(result["queries"].values()), 3)
    assert result["rows"] == {"consumption_by_type": 3, "gold_5min_stream": 753}
