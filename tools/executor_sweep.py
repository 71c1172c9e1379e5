"""The reference's executor sweep, locally: the MR-FFT rounds and the
outlier step (M=3, K=100, L=16) at local[c] for several core counts, each in
a fresh process.  Prints one JSON line per core count.

    python tools/executor_sweep.py [sf_dir] [cores ...]
    SWEEP_POINTS=<parquet with id, x, y> python tools/executor_sweep.py ...
"""

from __future__ import annotations

import json
import os
import subprocess
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CHILD = """
import json, sys, time
sys.path.insert(0, {root!r})
from farsight.session import local_session
import bench
spark = local_session({cores}, shuffle_partitions={cores})
bench.baseline_rounds(spark, {sf!r}, points_path={pts!r})          # warm-up
print(json.dumps({{"cores": {cores}, **bench.baseline_rounds(spark, {sf!r}, points_path={pts!r})}}))
"""


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    cores = [int(c) for c in sys.argv[2:]] or [2, 4, 8]
    for c in cores:
        out = subprocess.run([sys.executable, "-c", CHILD.format(root=HERE, cores=c, sf=sf,
                                                                pts=os.environ.get("SWEEP_POINTS"))],
                             capture_output=True, text=True, timeout=1800, cwd="/tmp")
        line = [x for x in out.stdout.splitlines() if x.startswith("{")]
        print(line[-1] if line else json.dumps({"cores": c, "error": out.stderr[-500:]}), flush=True)


if __name__ == "__main__":
    main()
