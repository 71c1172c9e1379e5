import json
import os
import subprocess
import sys

from conftest import ROOT, SF001


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF001, BENCH_CPUS="4")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd="/tmp",
                         capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == "0.001"
    assert rec["value"] > 0 and "outlier_pipeline" in rec["queries"]
