"""A task that dies mid-FFT is retried by Spark and the answer is unchanged
(the traversal is a deterministic function of its group)."""

import json
import os
import subprocess
import sys
import textwrap

from conftest import ROOT, SF001

SCRIPT = textwrap.dedent("""
    import json, os, sys
    sys.path.insert(0, {root!r})
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    from farsight.operators import kcenter
    from farsight.sources import points2d
    p = points2d(spark, {sf!r})
    clean = [r["id"] for r in kcenter.mr_fft_centers(p, 8, 4).orderBy("it").collect()]
    marker = {marker!r}
    orig = kcenter.farthest_first
    def flaky(X, K, start=0):
        if not os.path.exists(marker):
            open(marker, "w").close()
            raise RuntimeError("injected task failure")
        return orig(X, K, start)
    kcenter.farthest_first = flaky
    retried = [r["id"] for r in kcenter.mr_fft_centers(p, 8, 4).orderBy("it").collect()]
    print(json.dumps({{"clean": clean, "retried": retried, "failed": os.path.exists(marker)}}))
""")


def test_failed_fft_task_is_retried_with_same_result(tmp_path):
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(root=ROOT, sf=SF001, marker=str(tmp_path / "failed")))
    out = subprocess.run([sys.executable, str(script)], cwd=str(tmp_path), capture_output=True,
                         text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    rec = json.loads([line for line in out.stdout.splitlines() if line.startswith("{")][-1])
    assert rec["failed"] and rec["clean"] == rec["retried"] and len(rec["clean"]) == 8
