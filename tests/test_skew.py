"""A run key and a pipeline holding a third of all events must not put a
third of the rows into one task (partial aggregation, bounded group limits,
range-partitioned numbering).  Runs tools/skew_check.py in its own session
(event log on, partition coalescing off) and reads its JSON line."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from tests.conftest import SF01

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_hot_run_is_spread():
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "tools", "skew_check.py"), SF01],
        capture_output=True,
        text=True,
        timeout=900,
        cwd=ROOT,
    )
    line = [l for l in out.stdout.splitlines() if l.startswith("{")][-1]
    res = json.loads(line)
    assert res["hot_share"] > 0.3
    assert res["max_task_share_of_events"] < 0.1, res
