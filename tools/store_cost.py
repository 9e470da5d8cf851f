"""What a batch and a publish read as the store grows, from Spark's event log.

Adds equal batches to a fresh store, publishing now and then, and prints one
JSON line: the files that each batch has read (its own rows, the manifest, and
those of merges apart), those of each publish, and the live segments.

    python tools/store_cost.py [batches] [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def files_read(log_dir: str) -> list[tuple[float, int]]:
    """(start in seconds, files read) of each SQL execution."""
    files: set[int] = set()
    began: dict[int, float] = {}
    counts: dict[int, int] = {}

    def walk(plan: dict) -> None:
        files.update(m["accumulatorId"] for m in plan.get("metrics", []) if m["name"] == "number of files read")
        for child in plan.get("children", []):
            walk(child)

    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if os.path.isdir(path):
            continue
        with open(path, encoding="utf-8", errors="replace") as fh:
            events = [json.loads(line) for line in fh if "sql.execution.ui" in line]
        for e in events:
            if "sparkPlanInfo" in e:
                walk(e["sparkPlanInfo"])
            if e["Event"].endswith("SparkListenerSQLExecutionStart"):
                began[e["executionId"]] = e["time"] / 1000
        for e in events:
            if e["Event"].endswith("SparkListenerDriverAccumUpdates"):
                counts[e["executionId"]] = counts.get(e["executionId"], 0) + sum(v for a, v in e["accumUpdates"] if a in files)
    return sorted((began[i], n) for i, n in counts.items() if i in began)


def main() -> None:
    batches = int(sys.argv[1]) if len(sys.argv) > 1 else 50
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.001"
    from dataclasses import replace

    from pyspark.sql import functions as F

    from runlens.plans import refresh as RF
    from runlens.plans.store import Store
    from runlens.session import build_session, new_scratch
    from runlens.sources.fixture import fixture_config, fixture_logs
    from runlens.sources.logs import consolidate
    from runlens.sources.sinks import ensure_schema

    log_dir = tempfile.mkdtemp(prefix="runlens-store-events-")
    spark = build_session("local[4]", shuffle_partitions=4, app="runlens-store-cost", **{"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false"})
    cfg, name = fixture_config(), "runlens_store_cost"
    ensure_schema(spark, name, new_scratch(spark, name))
    store, logs = Store(spark, name, cfg), fixture_logs(spark, sf_dir)
    steps: list[tuple[str, float, float]] = []
    segments = []
    merge = RF.merge_segments

    def merging(*args):
        steps.append(("merge", time.time(), 0.0))
        out = merge(*args)
        steps[-1] = ("merge", steps[-1][1], time.time())
        return out

    RF.merge_segments = merging
    for i in range(batches):
        part = [replace(x, df=x.df.filter((F.col("id") % batches == i) & (F.dayofmonth("timestamp") <= 2))) for x in logs]
        begin = time.time()
        RF.apply_events(spark, consolidate(part, cfg), name, cfg, "tool", i)
        steps.append(("batch", begin, time.time()))
        segments.append(len(store.manifest().segments))
        if i + 1 in (batches // 5, batches):
            begin = time.time()
            RF.publish_tables(spark, name, cfg)
            steps.append(("publish", begin, time.time()))
    spark.stop()

    reads = files_read(log_dir)

    def read_in(begin: float, end: float) -> int:
        return sum(n for at, n in reads if begin <= at < end)

    merges = [(b, e) for kind, b, e in steps if kind == "merge"]
    own = [read_in(b, e) - sum(read_in(x, y) for x, y in merges if b <= x < e) for kind, b, e in steps if kind == "batch"]
    print(json.dumps({"batches": batches, "files_read_by_batch": own, "files_read_by_merges": sum(read_in(b, e) for b, e in merges), "files_read_by_publish": [read_in(b, e) for kind, b, e in steps if kind == "publish"], "live_segments": max(segments), "publish_seconds": [round(e - b, 2) for kind, b, e in steps if kind == "publish"]}))


if __name__ == "__main__":
    main()
