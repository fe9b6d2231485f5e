"""Lost tasks are retried and every result is unchanged (separate Spark process with
task retries enabled and failures injected into first attempts)."""

import json
import os
import subprocess
import sys

from conftest import SF_SMALL

SCRIPT = os.path.join(os.path.dirname(__file__), "scripts", "retry_check.py")


def test_results_survive_task_failures():
    out = subprocess.run(
        [sys.executable, SCRIPT, SF_SMALL], capture_output=True, text=True, timeout=600
    )
    assert out.returncode == 0, out.stderr[-2000:]
    line = [l for l in out.stdout.splitlines() if l.startswith("{")][-1]
    report = json.loads(line)
    assert all(report["same"].values()), report
    assert report["invalidated"] == 1096
