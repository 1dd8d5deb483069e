"""Task-level skew check from Spark's event log (tools/skew_probe.py, run
in its own Spark application): with one value and one entity holding a
third of the rows, no task of the cohortlens paths reads more than a
quarter of a raw-volume stage, while a plain global window puts the whole
stage in one task (the negative control)."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_hot_keys_spread_over_tasks(scratch):
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "tools", "skew_probe.py"), scratch, "600000"],
        capture_output=True, text=True, timeout=1200, check=True,
    ).stdout.strip().splitlines()[-1]
    shares = json.loads(out)
    assert shares.pop("naive_global_rank_window") == 1.0
    assert shares and all(0 < v <= 0.25 for v in shares.values()), shares
