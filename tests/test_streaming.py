"""Structured Streaming monitor: resumes from its checkpoint after a stop,
picks up new files, and its final state equals the batch fold."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from runlens.sources.fixture import fixture_config
from runlens.plans.pipeline import Pipeline
from runlens.plans.refresh import refresh
from runlens.session import new_scratch
from runlens.sources.logs import LogSource
from runlens.streaming.monitor import StreamLog, monitored_runs, start_run_monitor
from tests.conftest import SF001
from tests.test_properties import _rows
from tests.test_refresh import _same_tables


def test_stream_resumes_and_equals_batch(spark):
    cfg = fixture_config()
    p = Pipeline.from_fixture(spark, SF001, cfg)
    root = new_scratch(spark, "stream-test")
    mid = F.lit("2024-01-16").cast("date")

    def write(part, mode):
        paths = []
        for log in p.logs:
            path = f"{root}/input/{log.schema}/{log.table}"
            df = log.df.withColumn("event_day", F.to_date("timestamp"))
            df = df.filter(F.col("event_day") < mid) if part == 1 else df.filter(F.col("event_day") >= mid)
            df.write.mode(mode).partitionBy("event_day").parquet(path)
            paths.append((log, path))
        return paths

    paths = write(1, "overwrite")
    logs = [StreamLog(l.catalog, l.schema, l.table, path, spark.read.parquet(path).schema) for l, path in paths]
    db, ckpt = "rl_stream_test", f"{root}/checkpoint"
    q = start_run_monitor(spark, logs, db, ckpt, cfg, location=f"{root}/tables", max_files_per_trigger=4)
    q.awaitTermination()
    batches = spark.table(f"{db}.evlog_refresh_log").count()
    assert batches >= 2  # several micro-batches

    write(2, "append")  # later files arrive; runs straddling the 16th get late events
    q = start_run_monitor(spark, logs, db, ckpt, cfg, max_files_per_trigger=4)
    q.awaitTermination()
    assert spark.table(f"{db}.evlog_refresh_log").count() > batches
    assert _rows(monitored_runs(spark, db, cfg)) == _rows(p.run_report)
    # every published table, after several micro-batches and a restart
    full = refresh(spark, p.logs, "rl_stream_full", cfg, location=f"{root}/full", views=False)
    _same_tables(spark, {k: f"{db}.evlog_{k}" for k in full}, full)


def test_backfill_then_stream_counts_each_event_once(spark):
    cfg = fixture_config()
    root = new_scratch(spark, "backfill-test")
    logs, streams = [], []
    for log in Pipeline.from_fixture(spark, SF001, cfg).logs:
        path = f"{root}/input/{log.table}"
        log.df.filter("timestamp < '2024-01-16'").repartition(3).write.parquet(path)
        logs.append(LogSource(log.catalog, log.schema, log.table, spark.read.parquet(path)))
        streams.append(StreamLog(log.catalog, log.schema, log.table, path, logs[-1].df.schema))
    names = refresh(spark, logs, "rl_backfill", cfg, location=f"{root}/tables", views=False)
    n = spark.table(names["consolidated_events"]).count()
    for later in (False, True):
        if later:
            for log, own in zip(Pipeline.from_fixture(spark, SF001, cfg).logs, logs):
                log.df.filter("timestamp >= '2024-01-16' or timestamp is null").write.mode("append").parquet(f"{root}/input/{own.table}")
        start_run_monitor(spark, streams, "rl_backfill", f"{root}/checkpoint", cfg).awaitTermination()
        p = Pipeline.from_fixture(spark, SF001, cfg)
        if not later:
            assert spark.table(names["consolidated_events"]).count() == n
    assert spark.table(names["consolidated_events"]).count() == p.consolidated.count()
    assert _rows(spark.table(names["pipeline_runs"])) == _rows(p.run_report)


def test_each_batch_takes_its_time_from_the_clock(spark):
    cfg = fixture_config(days_back=10)
    root = new_scratch(spark, "clock-test")
    log = Pipeline.from_fixture(spark, SF001, cfg).logs[0]
    log.df.repartition(4).write.parquet(f"{root}/input")
    stream = StreamLog(log.catalog, log.schema, log.table, f"{root}/input", log.df.schema)
    late = cfg.time + dt.timedelta(days=5)
    start_run_monitor(spark, [stream], "rl_clock", f"{root}/checkpoint", cfg, location=f"{root}/tables", max_files_per_trigger=2, clock=lambda: late).awaitTermination()
    events = spark.table("rl_clock.evlog_consolidated_events")
    assert events.agg(F.min("consolidated_at")).first()[0] == late
    assert events.count() == log.df.filter(F.col("timestamp") >= F.lit(late - dt.timedelta(days=10))).count()
