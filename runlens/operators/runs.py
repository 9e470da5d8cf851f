"""Fold events into one row per pipeline run.

A run is keyed by (pipeline_id, pipeline_name, update_id, source_full_name);
group keys are null-safe, so events without an update id form one run per
pipeline and source.

The fold is split so that batch, incremental and streaming refresh share one
code path:

* ``run_state``  – one partial aggregate per run key whose every column is
  *mergeable* (min, max, sums, earliest-struct, and the set of event types,
  a small fixed vocabulary).  It aggregates with map-side partial combining,
  so a hot run key is reduced per partition before the shuffle.
* ``run_facts`` – the run's distinct ERROR messages and the flows they hit,
  one row each: error text carries ids, so a run may have any number of
  them, and no row may grow with it.
* ``finalize_runs`` – derives run_date, duration, status and applies the
  duration floor.  ``with_error_detail`` joins the facts as array columns,
  for reports alone.

Both states can be kept per event date (``by``); ``merge_run_state`` and
``merge_run_facts`` give the state of the union of any of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens import schema as S
from runlens.config import THRESHOLDS, Config
from runlens.functions.exprs import count_where, duration_minutes, earliest_non_null, level_is, run_status

MESSAGE, FLOW = "message", "flow"


def _counted(enriched: DataFrame, cfg: Config) -> DataFrame:
    return enriched.filter(F.col("update_id").isNotNull()) if cfg.exclude_null_updates else enriched


def run_state(enriched: DataFrame, cfg: Config | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Mergeable per-run partials of the enriched events."""
    cfg = cfg or THRESHOLDS
    return _counted(enriched, cfg).groupBy(*by, *S.RUN_KEYS).agg(
        F.min("timestamp").alias("run_start"),
        F.max("timestamp").alias("run_end"),
        F.count(F.lit(1)).alias("total_events"),
        F.array_sort(F.collect_set("event_type")).alias("event_types"),
        count_where(level_is(S.LEVEL_ERROR)).alias("error_count"),
        count_where(level_is(S.LEVEL_WARN)).alias("warning_count"),
        count_where(level_is(S.LEVEL_INFO)).alias("info_count"),
        earliest_non_null("cluster_id").alias("first_cluster"),
        earliest_non_null("pipeline_type").alias("first_pipeline_type"),
    )


def run_facts(enriched: DataFrame, cfg: Config | None = None, by: Sequence[str] = ()) -> DataFrame:
    """(run key, kind, value): distinct ERROR messages and flows per run."""
    cfg = cfg or THRESHOLDS
    errors = _counted(enriched, cfg).filter(level_is(S.LEVEL_ERROR))
    both = F.array(
        F.struct(F.lit(MESSAGE).alias("kind"), F.col("message").alias("value")),
        F.struct(F.lit(FLOW).alias("kind"), F.col("flow_name").alias("value")),
    )
    return errors.select(*by, *S.RUN_KEYS, F.inline(both)).filter(F.col("value").isNotNull()).distinct()


def merge_run_state(*states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """State of the union of the inputs of ``states``."""
    u = reduce(lambda a, b: a.unionByName(b), states)
    return u.groupBy(*by, *S.RUN_KEYS).agg(
        F.min("run_start").alias("run_start"),
        F.max("run_end").alias("run_end"),
        F.sum("total_events").alias("total_events"),
        # sorted sets over a small vocabulary: few distinct ones
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("event_types")))).alias("event_types"),
        F.sum("error_count").alias("error_count"),
        F.sum("warning_count").alias("warning_count"),
        F.sum("info_count").alias("info_count"),
        F.min("first_cluster").alias("first_cluster"),
        F.min("first_pipeline_type").alias("first_pipeline_type"),
    )


def merge_run_facts(*facts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    u = reduce(lambda a, b: a.unionByName(b), facts)
    return u.select(*by, *S.RUN_KEYS, "kind", "value").distinct()


def fact_counts(facts: DataFrame) -> DataFrame:
    """Per run, how many messages and flows its facts have."""
    return facts.groupBy(*S.RUN_KEYS).agg(count_where(F.col("kind") == MESSAGE).alias("n_messages"), count_where(F.col("kind") == FLOW).alias("n_flows"))


def with_fact_counts(runs: DataFrame, facts: DataFrame) -> DataFrame:
    """``runs`` with the numbers of their messages and flows: rows of bounded
    size, however many facts a run has."""
    counts = fact_counts(facts).select(*[F.col(k).alias(f"_f_{k}") for k in S.RUN_KEYS], "n_messages", "n_flows")
    none = F.lit(0).cast("long")
    return runs.join(counts, _same_run(runs, counts), "left").select(*runs.columns, F.coalesce("n_messages", none).alias("n_messages"), F.coalesce("n_flows", none).alias("n_flows"))


def finalize_runs(state: DataFrame, cfg: Config | None = None, keep_all: bool = False) -> DataFrame:
    """Runs table from a run state; ``keep_all`` skips the duration floor."""
    cfg = cfg or THRESHOLDS
    errors = F.col("error_count")
    runs = state.select(
        *S.RUN_KEYS,
        "run_start",
        "run_end",
        F.to_date("run_start").alias("run_date"),
        "total_events",
        F.size("event_types").cast("long").alias("unique_event_types"),
        "error_count",
        "warning_count",
        "info_count",
        F.col("first_cluster.v").alias("cluster_id"),
        F.col("first_pipeline_type.v").alias("pipeline_type"),
        duration_minutes("run_start", "run_end").alias("duration_minutes"),
        (errors > 0).alias("has_errors"),
        run_status(errors, F.col("total_events"), cfg.incomplete_below_events).alias("status"),
    )
    return runs if keep_all else runs.filter(F.col("duration_minutes") > F.lit(cfg.min_run_minutes))


def _same_run(left: DataFrame, right: DataFrame) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_f_{k}"]) for k in S.RUN_KEYS])


def with_error_detail(runs: DataFrame, facts: DataFrame, datasets: bool = False) -> DataFrame:
    """``runs`` with ``error_messages`` (sorted distinct) and, on request,
    ``error_datasets``.  The only place where facts become arrays; read
    ``run_facts`` itself where a run may have very many."""

    def values(kind: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.col("value"))))

    lists = facts.groupBy(*S.RUN_KEYS).agg(values(MESSAGE).alias("_messages"), values(FLOW).alias("_flows"))
    lists = lists.select(*[F.col(k).alias(f"_f_{k}") for k in S.RUN_KEYS], "_messages", "_flows")
    empty = F.array().cast("array<string>")
    joined = runs.join(lists, _same_run(runs, lists), "left")
    out = []
    for c in runs.columns:
        out.append(runs[c])
        if c == "info_count":
            out.append(F.coalesce("_messages", empty).alias("error_messages"))
    return joined.select(*out, *([F.coalesce("_flows", empty).alias("error_datasets")] if datasets else []))


def pipeline_runs(enriched: DataFrame, cfg: Config | None = None) -> DataFrame:
    """One row per run that lasted longer than ``cfg.min_run_minutes``."""
    return with_error_detail(finalize_runs(run_state(enriched, cfg), cfg), run_facts(enriched, cfg))
