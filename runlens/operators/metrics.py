"""Aggregate tables derived from runs and events.

Every table is one ``groupBy().agg()`` over the runs table (or the enriched
events for error analysis), so each is a single shuffle on its keys with
map-side partial aggregation; the runs table is orders of magnitude smaller
than the events it folds.  Duration means and deviations are computed from
exact integer sums of whole seconds, so they do not depend on partitioning.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens import schema as S
from runlens.config import THRESHOLDS, Config
from runlens.functions.exprs import (
    count_where,
    date_literal,
    level_is,
    mean_minutes,
    ratio,
    status_is,
    stddev_minutes,
)


# The reading order of three tables; each is total.
RECENT_ORDER = (("run_date", False), ("pipeline_name", True))
TREND_ORDER = (("avg_minutes", False), ("pipeline_name", True))
CLUSTER_ORDER = (("pipeline_name", True), ("runs_on_cluster", False), ("cluster_id", True))


def ordered(order: tuple[tuple[str, bool], ...]) -> list[Column]:
    """Sort columns: ascending with nulls first, descending with nulls last."""
    return [F.col(c).asc_nulls_first() if up else F.col(c).desc_nulls_last() for c, up in order]


def performance_metrics(runs: DataFrame) -> DataFrame:
    """Per (pipeline_name, pipeline_id): run counts, duration statistics,
    error/warning totals, rates.  INCOMPLETE runs count in total_runs only,
    so success_rate + failure_rate may be < 1."""
    return (
        runs.groupBy("pipeline_name", "pipeline_id")
        .agg(
            F.count(F.lit(1)).alias("total_runs"),
            mean_minutes().alias("avg_duration_minutes"),
            F.min("duration_minutes").alias("min_duration_minutes"),
            F.max("duration_minutes").alias("max_duration_minutes"),
            stddev_minutes().alias("duration_stddev"),
            F.sum("error_count").alias("total_errors"),
            F.sum("warning_count").alias("total_warnings"),
            count_where(status_is(S.STATUS_SUCCESS)).alias("successful_runs"),
            count_where(status_is(S.STATUS_FAILED)).alias("failed_runs"),
            F.count_distinct("cluster_id").alias("unique_clusters"),
            F.max("run_date").alias("last_run_date"),
            F.avg("total_events").alias("avg_events_per_run"),
        )
        .withColumn("success_rate", ratio("successful_runs", "total_runs"))
        .withColumn("failure_rate", ratio("failed_runs", "total_runs"))
        .withColumn("avg_duration_hours", F.col("avg_duration_minutes") / F.lit(60))
    )


def error_analysis(enriched: DataFrame, cfg: Config | None = None) -> DataFrame:
    """ERROR events per (pipeline_name, pipeline_id, event_type).

    Starts from the events, so it also counts errors of runs dropped by the
    duration floor.  One partially aggregated pass; ``sample_message`` is the
    earliest non-null message (by time, then text).  All messages of a group
    are in ``errors.error_messages``, one row each."""
    text = F.col("message")
    errors = enriched.filter(level_is(S.LEVEL_ERROR))
    out = errors.groupBy("pipeline_name", "pipeline_id", "event_type").agg(
        F.count(F.lit(1)).alias("error_count"),
        F.count_distinct("update_id").alias("affected_runs"),
        F.min("timestamp").alias("first_error"),
        F.max("timestamp").alias("last_error"),
        F.min(F.when(text.isNotNull(), F.struct(F.col("timestamp").isNull().alias("late"), "timestamp", "message"))).alias("_first"),
    )
    return out.withColumn("sample_message", F.col("_first.message")).drop("_first")


def recent_activity(runs: DataFrame, cfg: Config | None = None, days: int | None = None) -> DataFrame:
    """Per (run_date, pipeline_name) over runs that started on or after
    ``as_of - days`` (inclusive: up to days+1 calendar dates)."""
    cfg = cfg or THRESHOLDS
    days = cfg.recent_days if days is None else days
    since = date_literal(cfg.as_of_date - dt.timedelta(days=days))
    return (
        runs.filter(F.col("run_date") >= since)
        .groupBy("run_date", "pipeline_name")
        .agg(
            F.count(F.lit(1)).alias("total_runs"),
            count_where(status_is(S.STATUS_SUCCESS)).alias("successful_runs"),
            count_where(status_is(S.STATUS_FAILED)).alias("failed_runs"),
            mean_minutes().alias("avg_duration"),
            F.sum("total_events").alias("total_events"),
        )
        .withColumn("success_rate_daily", ratio("successful_runs", "total_runs"))
        .orderBy(*ordered(RECENT_ORDER))
    )


def duration_trends(runs: DataFrame, cfg: Config | None = None) -> DataFrame:
    """Per pipeline_name over runs longer than ``cfg.trend_min_minutes``.
    Median and P95 use ``percentile_approx`` (a bounded, mergeable sketch)."""
    cfg = cfg or THRESHOLDS
    return (
        runs.filter(F.col("duration_minutes") > F.lit(cfg.trend_min_minutes))
        .groupBy("pipeline_name")
        .agg(
            F.count(F.lit(1)).alias("runs"),
            mean_minutes().alias("avg_minutes"),
            F.max("duration_minutes").alias("max_minutes"),
            F.min("duration_minutes").alias("min_minutes"),
            F.percentile_approx("duration_minutes", 0.5).alias("median_minutes"),
            F.percentile_approx("duration_minutes", 0.95).alias("p95_minutes"),
        )
        .orderBy(*ordered(TREND_ORDER))
    )


def cluster_usage(runs: DataFrame) -> DataFrame:
    """Per (pipeline_name, cluster_id); a null cluster is its own group."""
    return (
        runs.groupBy("pipeline_name", "cluster_id")
        .agg(
            F.count(F.lit(1)).alias("runs_on_cluster"),
            mean_minutes().alias("avg_duration_on_cluster"),
            count_where(status_is(S.STATUS_SUCCESS)).alias("successful_runs"),
        )
        .withColumn("success_rate_cluster", ratio("successful_runs", "runs_on_cluster"))
        .orderBy(*ordered(CLUSTER_ORDER))
    )
