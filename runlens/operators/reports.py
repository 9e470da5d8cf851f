"""Analyses the reference documents in prose and SQL examples but does not
build.  Definitions that the reference leaves open are ours and are
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens import schema as S
from runlens.config import THRESHOLDS, Config
from runlens.functions.exprs import (
    count_where,
    date_literal,
    duration_minutes,
    error_signature,
    level_is,
    linear_fit_minutes,
    mean_minutes,
    ratio,
    status_is,
)
from runlens.operators.quantiles import exact_percentiles
from runlens.operators.runs import with_error_detail
from runlens.operators.sequence import running_totals
from runlens.session import materialize as checkpoint


def stage_counts(consolidated: DataFrame, cfg: Config | None = None) -> DataFrame:
    """Row counts of every stage (consolidated, enriched, run groups, runs)
    from one pass: events are folded by run key *before* dropping those
    without a pipeline id, so the dropped events form their own groups and
    every count is a sum over one small aggregate."""
    cfg = cfg or THRESHOLDS
    pid = F.col("origin.pipeline_id")
    groups = consolidated.groupBy(
        pid.alias("pipeline_id"),
        F.col("origin.pipeline_name").alias("pipeline_name"),
        F.col("origin.update_id").alias("update_id"),
        "source_full_name",
    ).agg(
        F.count(F.lit(1)).alias("events"),
        F.min("timestamp").alias("run_start"),
        F.max("timestamp").alias("run_end"),
    )
    named = F.col("pipeline_id").isNotNull()
    totals = groups.agg(
        F.sum("events").alias("consolidated"),
        F.coalesce(F.sum(F.when(named, F.col("events"))), F.lit(0)).alias("enriched"),
        F.count_if(named).alias("run_groups"),
        F.count_if(named & (duration_minutes("run_start", "run_end") > F.lit(cfg.min_run_minutes))).alias("runs"),
    )
    names = ("consolidated", "enriched", "run_groups", "runs")
    return totals.select(
        F.explode(F.array(*[F.struct(F.lit(n).alias("stage"), F.col(n).cast("long").alias("row_count")) for n in names])).alias("s")
    ).select("s.stage", "s.row_count")


def status_breakdown(runs: DataFrame) -> DataFrame:
    """Runs and events per status."""
    return runs.groupBy("status").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("total_events").alias("events"),
        F.sum("error_count").alias("errors"),
    )


def daily_success_rate(runs: DataFrame) -> DataFrame:
    """Overall success rate by run date, all pipelines together."""
    return (
        runs.groupBy("run_date")
        .agg(
            F.count(F.lit(1)).alias("total_runs"),
            count_where(status_is(S.STATUS_SUCCESS)).alias("successful_runs"),
            count_where(status_is(S.STATUS_FAILED)).alias("failed_runs"),
        )
        .withColumn("success_rate", ratio("successful_runs", "total_runs"))
    )


def performance_percentiles(runs: DataFrame) -> DataFrame:
    """P50 / P95 duration per (pipeline_name, pipeline_id) over kept runs."""
    return runs.groupBy("pipeline_name", "pipeline_id").agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.percentile_approx("duration_minutes", 0.5).alias("p50_duration_minutes"),
        F.percentile_approx("duration_minutes", 0.95).alias("p95_duration_minutes"),
    )


def daily_duration_trends(runs: DataFrame) -> DataFrame:
    """Daily median and P95 per pipeline name (no duration floor)."""
    return runs.groupBy("pipeline_name", "run_date").agg(
        F.count(F.lit(1)).alias("runs"),
        mean_minutes().alias("avg_minutes"),
        F.percentile_approx("duration_minutes", 0.5).alias("median_minutes"),
        F.percentile_approx("duration_minutes", 0.95).alias("p95_minutes"),
    )


def clusters_per_pipeline(runs: DataFrame, materialize: bool = True) -> DataFrame:
    """Distinct clusters used per pipeline: one row per (pipeline, cluster)
    with its runs and first/last use, plus the pipeline's number of distinct
    clusters (runs without a cluster form a null-cluster row; count 0 when a
    pipeline never had one).

    Long form on purpose: with one job cluster per run a pipeline's cluster
    set grows with its runs, and an array per pipeline would put a hot
    pipeline's whole set in one task.  Grouping by (pipeline, cluster)
    spreads it; the per-pipeline count is one row per pipeline."""
    used = runs.groupBy("pipeline_name", "pipeline_id", "cluster_id").agg(
        F.count(F.lit(1)).alias("runs"),
        F.min("run_start").alias("first_used"),
        F.max("run_start").alias("last_used"),
    )
    if materialize:  # read by both branches below: fold the runs once
        used = checkpoint(used)
    counts = used.groupBy("pipeline_name", "pipeline_id").agg(F.count("cluster_id").alias("unique_clusters"))
    counts = counts.select(
        F.col("pipeline_name").alias("_n"), F.col("pipeline_id").alias("_i"), "unique_clusters"
    )
    cond = used["pipeline_name"].eqNullSafe(counts["_n"]) & used["pipeline_id"].eqNullSafe(counts["_i"])
    return used.join(counts, cond, "inner").drop("_n", "_i")


def error_signatures(enriched: DataFrame) -> DataFrame:
    """ERROR events grouped by message shape (digit runs -> ``#``); a null
    message is its own signature."""
    return (
        enriched.filter(level_is(S.LEVEL_ERROR))
        .withColumn("signature", error_signature("message"))
        .groupBy("signature")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count_distinct("update_id").alias("runs"),
            F.count_distinct("pipeline_id").alias("pipelines"),
            F.min("timestamp").alias("first_seen"),
            F.max("timestamp").alias("last_seen"),
        )
    )


def run_flow_breakdown(enriched: DataFrame) -> DataFrame:
    """Time by flow inside each run: first/last event, event count and the
    whole-second span in minutes (no duration floor)."""
    return (
        enriched.groupBy(*S.RUN_KEYS, "flow_name")
        .agg(
            F.min("timestamp").alias("first_event"),
            F.max("timestamp").alias("last_event"),
            F.count(F.lit(1)).alias("events"),
            count_where(level_is(S.LEVEL_ERROR)).alias("errors"),
        )
        .withColumn("span_minutes", duration_minutes("first_event", "last_event"))
    )


ALONE, SHARED, IDLE = "alone", "shared", "idle"


def run_time_split(enriched: DataFrame) -> DataFrame:
    """Where the whole seconds of each run went: those in which one flow alone
    was between its first and last event (a row per flow), those in which
    several were, and those in which none was; they add up to the run's span.

    A sweep over the ends of the flows' intervals.  With the flows that are
    open at each end as running sums (how many, and the sum of their numbers,
    which is the flow's own where there is one), the time in a state is the
    sum of the times at which it ends less those at which it begins.  So no
    row needs its neighbour, and a run with very many flows spreads over tasks."""
    spans = run_flow_breakdown(enriched).filter(F.col("first_event").isNotNull())
    # any distinct numbers will do; they are fixed by the checkpoint below
    numbered = checkpoint(spans.select(*S.RUN_KEYS, "flow_name", "first_event", "last_event", F.monotonically_increasing_id().alias("flow")))
    start = F.struct(F.unix_timestamp("first_event").alias("at"), F.lit(1).alias("open"), F.col("flow").alias("flow"))
    end = F.struct(F.unix_timestamp("last_event").alias("at"), F.lit(-1).alias("open"), (-F.col("flow")).alias("flow"))
    ends = numbered.select(*S.RUN_KEYS, F.inline(F.array(start, end)))
    swept = running_totals(ends, S.RUN_KEYS, ["at", F.col("open").desc()], ["open", "flow"])

    def state(n: Column, flow: Column) -> Column:
        kind = F.when(n > 1, SHARED).when(n == 1, ALONE).otherwise(IDLE)
        return F.struct(kind.alias("kind"), F.when(n == 1, flow).alias("flow"))

    after = state(F.col("run_open"), F.col("run_flow"))
    before = state(F.col("run_open") - F.col("open"), F.col("run_flow") - F.col("flow"))
    sides = F.array(F.struct(before.alias("state"), F.col("at").alias("signed")), F.struct(after.alias("state"), (-F.col("at")).alias("signed")))
    totals = swept.select(*S.RUN_KEYS, F.inline(sides)).groupBy(*S.RUN_KEYS, "state.kind", "state.flow").agg(F.sum("signed").alias("seconds"), F.count(F.lit(1)).alias("_n"))
    # before the first and after the last end nothing is open, and that is no
    # time of the run: it counts as idle with the span the wrong way round
    span = numbered.groupBy(*S.RUN_KEYS).agg((F.max(F.unix_timestamp("last_event")) - F.min(F.unix_timestamp("first_event"))).alias("_span"))
    names = numbered.select(F.col("flow").alias("_flow"), "flow_name")
    keyed = totals.select(*[F.col(k).alias(f"_k_{k}") for k in S.RUN_KEYS], "kind", "flow", "seconds")
    of_run = reduce(lambda a, b: a & b, [keyed[f"_k_{k}"].eqNullSafe(span[k]) for k in S.RUN_KEYS])
    out = keyed.join(span, of_run).join(names, F.col("flow") == F.col("_flow"), "left")
    seconds = F.col("seconds") + F.when(F.col("kind") == IDLE, F.col("_span")).otherwise(F.lit(0))
    return out.select(*S.RUN_KEYS, "kind", "flow_name", seconds.alias("seconds")).filter("seconds > 0")


def duration_slope(runs: DataFrame, cfg: Config | None = None) -> DataFrame:
    """Linear trend of run duration per pipeline: x = days from ``as_of``
    to the run date, so the intercept is the fitted value at ``as_of`` and
    the projection is the value ``projection_days`` later."""
    cfg = cfg or THRESHOLDS
    x = F.datediff(F.col("run_date"), date_literal(cfg.as_of_date))
    slope, intercept = linear_fit_minutes(x)
    return (
        runs.groupBy("pipeline_name", "pipeline_id")
        .agg(
            F.count(F.lit(1)).alias("runs"),
            slope.alias("slope_minutes_per_day"),
            intercept.alias("fitted_minutes_at_as_of"),
        )
        .withColumn(
            "projected_minutes",
            F.col("fitted_minutes_at_as_of") + F.col("slope_minutes_per_day") * F.lit(float(cfg.projection_days)),
        )
    )


def failed_run_detail(runs: DataFrame, facts: DataFrame) -> DataFrame:
    """Failed runs with their error messages and the datasets (flows) hit."""
    failed = runs.filter(status_is(S.STATUS_FAILED)).select(*S.RUN_KEYS, "run_start", "duration_minutes", "error_count", "info_count")
    return with_error_detail(failed, facts, datasets=True).drop("info_count")


def duration_outliers(runs: DataFrame, cfg: Config | None = None, materialize: bool = True) -> DataFrame:
    """Runs longer than Q3 + k * (Q3 - Q1) of their pipeline (Tukey fence,
    exact interpolated quartiles per pipeline_id).  ``runs`` feeds both the
    quartiles and the comparison; with ``materialize`` the needed columns
    are checkpointed once."""
    cfg = cfg or THRESHOLDS
    if materialize:
        runs = checkpoint(runs.select(*S.RUN_KEYS, "run_start", "duration_minutes"))
    q = exact_percentiles(runs, ["pipeline_id"], "duration_minutes", [0.25, 0.75], ["q1_minutes", "q3_minutes"])
    q = q.select(
        F.col("pipeline_id").alias("_q_pipeline_id"),
        "q1_minutes",
        "q3_minutes",
        (F.col("q3_minutes") + F.lit(cfg.outlier_iqr_factor) * (F.col("q3_minutes") - F.col("q1_minutes"))).alias(
            "upper_fence_minutes"
        ),
    )
    # one row per pipeline on the right: AQE broadcasts it when its measured
    # size is under the threshold, else a sort-merge join (skew-split by AQE)
    j = runs.join(q, runs["pipeline_id"] == q["_q_pipeline_id"], "inner")
    return j.filter(F.col("duration_minutes") > F.col("upper_fence_minutes")).select(
        *S.RUN_KEYS, "run_start", "duration_minutes", "q1_minutes", "q3_minutes", "upper_fence_minutes"
    )
