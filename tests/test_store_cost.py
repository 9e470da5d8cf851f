"""What a batch reads doesn't grow with the store (figures of the event log)."""

from __future__ import annotations

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_files_read_stay_flat_over_50_batches():
    out = subprocess.run([sys.executable, f"{ROOT}/tools/store_cost.py", "50"], cwd=ROOT, capture_output=True, text=True, timeout=900, check=True)
    figures = json.loads(out.stdout.strip().splitlines()[-1])
    reads = figures["files_read_by_batch"]
    assert len(reads) == 50 and min(reads) > 0
    # its own files and an era of the manifest: more until the era is rolled,
    # and no more than that after any number of eras
    assert max(reads[25:]) <= max(reads[:25]) + 10
    assert sorted(reads[-16:])[8] <= sorted(reads[4:20])[8] + 10
    # 8 segments of a level become one
    assert figures["live_segments"] <= 7 + 7
