"""Skew check: one run key and one pipeline hold a third of all events.

Rewrites the fixture logs so that every third event belongs to a single
pipeline with a null update id (one hot run), runs the run fold, error
analysis and alerts, and reads per-task shuffle records back from Spark's
event log.  Prints one JSON line with the hot share and the largest share of
all events that any single task read from a shuffle.

    python tools/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from pyspark.sql import functions as F

    from runlens.sources.fixture import fixture_config
    from runlens.operators import metrics as M
    from runlens.operators import ranking as R
    from runlens.plans.pipeline import Pipeline
    from runlens.session import build_session
    from runlens.sources.fixture import fixture_logs
    from runlens.sources.logs import LogSource

    log_dir = tempfile.mkdtemp(prefix="runlens-skew-events-")
    spark = build_session(
        "local[4]",
        shuffle_partitions=16,
        app="runlens-skew",
        **{
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": log_dir,
            "spark.eventLog.compress": "false",
            # keep every shuffle partition visible as its own task
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        },
    )
    hot = F.col("id") % 3 == 0
    origin = F.col("origin")
    logs = [
        LogSource(
            l.catalog,
            l.schema,
            l.table,
            l.df.withColumn(
                "origin",
                F.when(
                    hot,
                    origin.withField("pipeline_id", F.lit("p_hot"))
                    .withField("pipeline_name", F.lit("pipe_hot"))
                    .withField("update_id", F.lit(None).cast("string")),
                ).otherwise(origin),
            ),
        )
        for l in fixture_logs(spark, sf_dir)
    ]
    cfg = fixture_config()
    p = Pipeline(logs, cfg)
    total = p.consolidated.count()
    hot_events = p.enriched.filter(F.col("pipeline_id") == "p_hot").count()
    for name, df in (
        ("run_fold", p.runs),
        ("error_analysis", M.error_analysis(p.enriched, cfg)),
        ("alerts", R.alert_candidates(p.runs, cfg)),
    ):
        spark.sparkContext.setJobDescription(name)
        df.write.format("noop").mode("overwrite").save()
    spark.stop()

    worst = 0
    per_stage = {}
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if os.path.isdir(path):
            continue
        with open(path, encoding="utf-8", errors="replace") as fh:
            for line in fh:
                if '"SparkListenerTaskEnd"' not in line:
                    continue
                e = json.loads(line)
                m = e.get("Task Metrics") or {}
                recs = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                stage = e["Stage ID"]
                per_stage[stage] = max(per_stage.get(stage, 0), recs)
                worst = max(worst, recs)
    print(
        json.dumps(
            {
                "events": total,
                "hot_run_events": hot_events,
                "hot_share": round(hot_events / total, 3),
                "max_task_shuffle_records": worst,
                "max_task_share_of_events": round(worst / total, 4),
            }
        )
    )


if __name__ == "__main__":
    main()
