"""Percentiles of sliding windows from daily states."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from runlens.operators.sliding import SKETCH_K, daily_durations, daily_sketches, exact_sliding_percentiles, rank_error, sketch_errors, sketched_percentiles
from runlens.sources.fixture import fixture_config

DAY0 = dt.datetime(2024, 1, 1)


def runs(spark, rows):
    """(pipeline, day, seconds) as runs"""
    starts = [(f"n{p}" if p is not None else None, p, DAY0 + dt.timedelta(days=d), DAY0 + dt.timedelta(days=d, seconds=s)) for p, d, s in rows]
    df = spark.createDataFrame(starts, "pipeline_name string, pipeline_id string, run_start timestamp_ntz, run_end timestamp_ntz")
    return df.withColumn("run_date", F.to_date("run_start")).repartition(5)


def test_small_windows_are_exact(spark):
    rows = [(p, d, 60 * d + i) for p in ("a", None) for d in (0, 1, 5, 29) for i in range(d + 1)]
    cfg = fixture_config()
    got = {(r.pipeline_id, r.window_end): r for r in exact_sliding_percentiles(daily_durations(runs(spark, rows)), cfg, 3, {"p50": 0.5}).collect()}
    sketched = {(r.pipeline_id, r.window_end): r for r in sketched_percentiles(daily_sketches(runs(spark, rows)), cfg, 3, {"p50": 0.5}).collect()}
    assert set(got) == set(sketched)
    for p in ("a", None):
        for end in range(31):
            values = sorted(s for q, d, s in rows if q == p and end - 2 <= d <= end)
            key = (p, (DAY0 + dt.timedelta(days=end)).date())
            assert (key in got) == bool(values)
            if values:
                n = len(values)
                assert got[key].runs == sketched[key].runs == n
                assert got[key].p50 == (values[(n - 1) // 2] + values[n // 2]) / 2
                assert sketched[key].p50 in (values[(n - 1) // 2], values[n // 2])
    assert max(k[1] for k in got) == cfg.as_of_date  # no window ends after the reference time


def test_merged_sketches_keep_their_error(spark):
    """Windows of many more runs than the sketch holds; three times the stated
    error, so that chance doesn't fail it."""
    r = random.Random(4)
    rows = [("a", d, int(r.expovariate(1 / 900)) + 10 * d) for d in range(14) for _ in range(3_000)]
    cfg, made = fixture_config(), runs(spark, rows)
    sketches = daily_sketches(made)
    assert max(len(x.sketch) for x in sketches.collect()) < 40 * SKETCH_K
    some = {"p05": 0.05, "p50": 0.5, "p95": 0.95, "p99": 0.99}
    errors = sketch_errors(sketched_percentiles(sketches, cfg, 7, some), daily_durations(made), cfg, 7, some).collect()
    assert len(errors) == 20
    assert max(x.rank_error for x in errors) <= 3 * rank_error()
    assert sum(x.rank_error <= rank_error() for x in errors) >= 15


def test_no_runs(spark):
    empty, cfg = runs(spark, [("a", 0, 1)]).limit(0), fixture_config()
    assert sketched_percentiles(daily_sketches(empty), cfg).collect() == [] == exact_sliding_percentiles(daily_durations(empty), cfg).collect()
