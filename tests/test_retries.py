"""Task failures during a landing are retried by Spark; results and counts stay exact."""

import json
import os
import subprocess
import sys

HERE = os.path.dirname(os.path.abspath(__file__))


def test_landing_survives_task_failures():
    proc = subprocess.run([sys.executable, os.path.join(HERE, "retry_job.py")],
                          capture_output=True, text=True, timeout=600)
    lines = [ln for ln in proc.stdout.splitlines() if ln.startswith("RESULT ")]
    assert lines, proc.stderr[-3000:]
    out = json.loads(lines[-1][len("RESULT "):])
    assert out["r1"] == [10000, 10000]
    assert out["r2"] == [20000, 10000, 10000]
    assert out["landed"] == out["distinct"] == 20000
