"""Rankings, top-k reports, filters of the reference's SQL examples, and
alert candidates.

Top-k reports are ``orderBy(...).limit(n)``, which Spark plans as
``TakeOrderedAndProject``: each partition keeps its best ``n`` rows and
only ``n x partitions`` rows meet in the final task.  Every sort ends with
enough columns to be total, so ties never make the result arbitrary.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens import schema as S
from runlens.config import THRESHOLDS, Config
from runlens.functions.exprs import time_literal
from runlens.operators.metrics import cluster_usage, performance_metrics
from runlens.operators.sequence import number_within, trailing_stats
from runlens.session import materialize as checkpoint


def _desc(c: str):
    return F.col(c).desc_nulls_last()


def _asc(c: str):
    return F.col(c).asc_nulls_first()


# ------------------------------------------------------------------ top-k


def latest_events(consolidated: DataFrame, n: int = 20) -> DataFrame:
    cols = ["timestamp", "level", "event_type", "source_full_name", "message"]
    return consolidated.select(*cols).orderBy(_desc("timestamp"), *[_asc(c) for c in cols[1:]]).limit(n)


def latest_runs(runs: DataFrame, n: int = 20) -> DataFrame:
    cols = ["pipeline_name", "run_date", "run_start", "duration_minutes", "status", "error_count", "total_events", "cluster_id"]
    return (
        runs.orderBy(_desc("run_start"), *[_asc(c) for c in S.RUN_KEYS])
        .limit(n)
        .select(*cols)
    )


def busiest_pipelines(perf: DataFrame) -> DataFrame:
    return perf.select(
        "pipeline_name", "pipeline_id", "total_runs", "success_rate", "avg_duration_minutes",
        "max_duration_minutes", "last_run_date", "unique_clusters",
    ).orderBy(_desc("total_runs"), _asc("pipeline_name"), _asc("pipeline_id"))


def top_errors(errors: DataFrame, n: int = 15) -> DataFrame:
    return (
        errors.orderBy(_desc("error_count"), _asc("pipeline_name"), _asc("pipeline_id"), _asc("event_type"))
        .limit(n)
        .select("pipeline_name", "event_type", "error_count", "affected_runs", "first_error", "last_error", "sample_message")
    )


def slowest_pipelines(perf: DataFrame) -> DataFrame:
    return perf.select("pipeline_name", "pipeline_id", "avg_duration_minutes", "max_duration_minutes").orderBy(
        _desc("avg_duration_minutes"), _asc("pipeline_name"), _asc("pipeline_id")
    )


def failed_runs(runs: DataFrame, since: dt.datetime | None = None) -> DataFrame:
    """Failed runs, newest first; optionally only those started at/after ``since``."""
    r = runs.filter(F.col("status") == S.STATUS_FAILED)
    if since is not None:
        ts_type = runs.schema["run_start"].dataType
        r = r.filter(F.col("run_start") >= time_literal(since, ts_type))
    return r.orderBy(_desc("run_start"), _asc("pipeline_name"), *[_asc(c) for c in S.RUN_KEYS if c != "pipeline_name"]).select(
        "pipeline_name", "run_start", "duration_minutes", "error_count"
    )


def latest_errors(events: DataFrame, n: int = 10) -> DataFrame:
    """Last ``n`` ERROR events (all columns); ties by all sortable columns."""
    first = ("source_full_name", "id", "event_type", "message")
    sortable = [f.name for f in events.schema.fields if not isinstance(f.dataType, T.MapType)]
    tie = [c for c in first if c in sortable] + [c for c in sortable if c not in (*first, "timestamp")]
    return events.filter(F.col("level") == S.LEVEL_ERROR).orderBy(_desc("timestamp"), *[_asc(c) for c in tie]).limit(n)


def latest_run_status(runs: DataFrame, n: int = 20) -> DataFrame:
    return (
        runs.orderBy(_desc("run_start"), *[_asc(c) for c in S.RUN_KEYS])
        .limit(n)
        .select("pipeline_name", "status", "duration_minutes")
    )


def common_errors(errors: DataFrame, n: int = 25) -> DataFrame:
    return (
        errors.orderBy(_desc("error_count"), _asc("pipeline_name"), _asc("pipeline_id"), _asc("event_type"))
        .limit(n)
        .select("pipeline_name", "event_type", "error_count", "sample_message")
    )


def most_failing(perf: DataFrame) -> DataFrame:
    return perf.select("pipeline_name", "pipeline_id", "failed_runs", "total_runs", "failure_rate").orderBy(
        _desc("failure_rate"), _desc("failed_runs"), _asc("pipeline_name"), _asc("pipeline_id")
    )


def pipeline_rates(perf: DataFrame) -> DataFrame:
    return perf.select("pipeline_name", "success_rate", "avg_duration_minutes")


def pipeline_health(perf: DataFrame, min_success_rate: float = 0.95, max_avg_minutes: float = 60.0) -> DataFrame:
    """Pipelines below the success-rate target or above the duration target."""
    return perf.filter(
        (F.col("success_rate") < F.lit(min_success_rate)) | (F.col("avg_duration_minutes") > F.lit(max_avg_minutes))
    ).select("pipeline_name", "total_runs", "success_rate", "avg_duration_minutes")


def runs_by_name(runs: DataFrame, pipeline_name: str) -> DataFrame:
    return runs.filter(F.col("pipeline_name") == F.lit(pipeline_name))


# ------------------------------------------------------------- rankings


def cluster_reliability_rank(runs: DataFrame, materialize: bool = True) -> DataFrame:
    """Every (pipeline_name, cluster_id) with its place among the pipeline's
    clusters, 1 the most reliable and 1 the least reliable one: by success
    rate, then cluster id, nulls last in either direction.

    Places come from ``number_within``, so no task holds all clusters of a
    pipeline."""
    cu = cluster_usage(runs)
    if materialize:  # read by two numberings
        cu = checkpoint(cu)
    best = [F.col("success_rate_cluster").desc_nulls_last(), F.col("cluster_id").asc_nulls_last()]
    worst = [F.col("success_rate_cluster").asc_nulls_last(), F.col("cluster_id").desc_nulls_last()]
    both = number_within(number_within(cu, ["pipeline_name"], best, "_best"), ["pipeline_name"], worst, "_worst")
    return both.select(
        "pipeline_name",
        "cluster_id",
        "runs_on_cluster",
        "success_rate_cluster",
        (F.col("_best") + 1).alias("most_reliable_rank"),
        (F.col("_worst") + 1).alias("least_reliable_rank"),
    )


# ---------------------------------------------------------------- alerts

ALERT_COLUMNS = ("kind", "pipeline_name", "pipeline_id", "update_id", "source_full_name", "run_start", "value", "threshold")


def duration_spikes(runs: DataFrame, cfg: Config | None = None) -> DataFrame:
    """Runs longer than ``spike_factor`` x the mean duration of the
    ``spike_window_runs`` preceding runs of the same pipeline_id (ordered by
    start, then the run key).  Compared in whole seconds, so exact."""
    cfg = cfg or THRESHOLDS
    base = runs.select(
        *S.RUN_KEYS,
        "run_start",
        "duration_minutes",
        (F.unix_timestamp("run_end") - F.unix_timestamp("run_start")).alias("dur_s"),
    )
    numbered = number_within(base, ["pipeline_id"], [_asc("run_start"), _asc("pipeline_name"), _asc("update_id"), _asc("source_full_name")])
    st = trailing_stats(numbered, ["pipeline_id"], "dur_s", cfg.spike_window_runs)
    factor = F.lit(float(cfg.spike_factor))
    return st.filter(
        (F.col("prev_n") > 0) & (F.col("dur_s").cast("double") * F.col("prev_n") > factor * F.col("prev_sum"))
    ).select(
        F.lit("duration_spike").alias("kind"),
        "pipeline_name",
        "pipeline_id",
        "update_id",
        "source_full_name",
        "run_start",
        F.col("duration_minutes").alias("value"),
        (factor * F.col("prev_sum") / F.col("prev_n") / F.lit(60)).alias("threshold"),
    )


def failure_rate_alerts(runs: DataFrame, cfg: Config | None = None) -> DataFrame:
    cfg = cfg or THRESHOLDS
    perf = performance_metrics(runs)
    ts_type = runs.schema["run_start"].dataType
    return perf.filter(F.col("failure_rate") > F.lit(cfg.failure_rate_limit)).select(
        F.lit("failure_rate").alias("kind"),
        "pipeline_name",
        "pipeline_id",
        F.lit(None).cast("string").alias("update_id"),
        F.lit(None).cast("string").alias("source_full_name"),
        F.lit(None).cast(ts_type).alias("run_start"),
        F.col("failure_rate").alias("value"),
        F.lit(float(cfg.failure_rate_limit)).alias("threshold"),
    )


def error_bursts(runs: DataFrame, cfg: Config | None = None) -> DataFrame:
    """Runs with more than ``error_burst_factor`` x the mean error count of
    their pipeline_id (compared as integers: count * n > factor * sum)."""
    cfg = cfg or THRESHOLDS
    per = runs.groupBy("pipeline_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("error_count").alias("_sum")
    ).withColumnRenamed("pipeline_id", "_p")
    factor = F.lit(float(cfg.error_burst_factor))
    j = runs.join(per, runs["pipeline_id"] == per["_p"], "inner")
    return j.filter(
        (F.col("error_count") > 0) & (F.col("error_count").cast("double") * F.col("_n") > factor * F.col("_sum"))
    ).select(
        F.lit("error_burst").alias("kind"),
        "pipeline_name",
        "pipeline_id",
        "update_id",
        "source_full_name",
        "run_start",
        F.col("error_count").cast("double").alias("value"),
        (factor * F.col("_sum") / F.col("_n")).alias("threshold"),
    )


def alert_candidates(runs: DataFrame, cfg: Config | None = None, materialize: bool = True) -> DataFrame:
    """One row per alert: duration spikes, high failure rates, error bursts.

    The three kinds read ``runs`` in four branches; with ``materialize`` the
    runs are checkpointed once, so the fold behind them is not recomputed per
    branch."""
    cfg = cfg or THRESHOLDS
    if materialize:
        runs = checkpoint(runs)
    alerts = duration_spikes(runs, cfg).unionByName(failure_rate_alerts(runs, cfg)).unionByName(error_bursts(runs, cfg))
    return alerts.select(*ALERT_COLUMNS)
