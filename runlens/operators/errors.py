"""Mergeable state for error analysis, so a refresh can add a batch of
events without re-reading every ERROR row ever logged.

One long-form table, rows of three kinds per error group (pipeline_name,
pipeline_id, event_type):

* ``g`` – one row: error count, first and last error time;
* ``r`` – one row per distinct non-null update id (``affected_runs`` is
  their count; long form, so a group with many runs is not one array);
* ``m`` – one row per distinct non-null message: how often, first and last
  time.

All merge: counts add, times take min / max, ids take a distinct union.
Nothing is cut off.  ``finalize_error_state`` gives the same table as
``metrics.error_analysis`` over all events, ``error_messages`` every message.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens import schema as S
from runlens.functions.exprs import level_is

KEYS = ["pipeline_name", "pipeline_id", "event_type"]
GROUP, RUN, MESSAGE = "g", "r", "m"


def error_state(enriched: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Error state of a set of enriched events: one pass, in which each ERROR
    event counts for its group, its run and its message."""
    errors = enriched.filter(level_is(S.LEVEL_ERROR))
    rows = F.array(
        F.struct(F.lit(GROUP).alias("kind"), F.lit(None).cast("string").alias("value")),
        F.struct(F.lit(RUN).alias("kind"), F.col("update_id").alias("value")),
        F.struct(F.lit(MESSAGE).alias("kind"), F.col("message").alias("value")),
    )
    each = errors.select(*by, *KEYS, "timestamp", F.inline(rows)).filter((F.col("kind") == GROUP) | F.col("value").isNotNull())
    return each.groupBy(*by, *KEYS, "kind", "value").agg(
        F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("first_time"), F.max("timestamp").alias("last_time")
    )


def merge_error_state(*states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Error state of the union of the events behind ``states``."""
    u = reduce(lambda a, b: a.unionByName(b), states)
    return u.groupBy(*by, *KEYS, "kind", "value").agg(
        F.sum("n").alias("n"), F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time")
    )


def finalize_error_state(state: DataFrame) -> DataFrame:
    """The error-analysis table: one partially aggregated pass."""
    is_ = {k: F.col("kind") == k for k in (GROUP, RUN, MESSAGE)}
    first = F.struct(F.col("first_time").isNull().alias("late"), "first_time", "value")
    out = state.groupBy(*KEYS).agg(
        F.max(F.when(is_[GROUP], F.col("n"))).alias("error_count"),
        F.count_if(is_[RUN]).alias("affected_runs"),
        F.max(F.when(is_[GROUP], F.col("first_time"))).alias("first_error"),
        F.max(F.when(is_[GROUP], F.col("last_time"))).alias("last_error"),
        F.min(F.when(is_[MESSAGE], first)).alias("_first"),
    )
    return out.withColumn("sample_message", F.col("_first.value")).drop("_first")


def error_messages(state: DataFrame) -> DataFrame:
    """Every message of every error group: how often, first and last time."""
    return state.filter(F.col("kind") == MESSAGE).select(
        *KEYS, F.col("value").alias("message"), F.col("n").alias("error_count"), F.col("first_time").alias("first_error"), F.col("last_time").alias("last_error")
    )
