"""Percentiles of run durations over sliding windows, from daily states.

Two mergeable states per pipeline and day are kept beside the published runs,
so that the percentiles of any window come from one row per day, or from the
distinct durations, and never from the runs:

* ``daily_sketches`` – a KLL sketch of the durations: a few KB however many
  runs a day has.  Its rank error is at most ``rank_error(k)`` with 99 %
  confidence, and it is exact while a window has at most ``k`` runs;
* ``daily_durations`` – how often each duration (whole seconds) came up: the
  exact histogram, as large as the durations are many.

A window is the ``days`` days up to its end, one window for each day on which
it holds a run.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.config import Config
from runlens.functions.exprs import date_literal, run_seconds
from runlens.operators.quantiles import exact_percentiles

PIPELINE = ("pipeline_name", "pipeline_id")
DAY = (*PIPELINE, "run_date")
WINDOW = (*PIPELINE, "window_end")
SKETCH_K = 400
PROBABILITIES = {"p50": 0.5, "p95": 0.95}


def rank_error(k: int = SKETCH_K) -> float:
    """Normalised rank error of a KLL sketch, one-sided, at 99 % confidence."""
    return 2.296 / k**0.9723


def daily_sketches(runs: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """(pipeline, run_date, runs, sketch) of the runs' durations in seconds."""
    return runs.groupBy(*DAY).agg(F.count(F.lit(1)).alias("runs"), F.kll_sketch_agg_bigint(run_seconds(), k).alias("sketch"))


def daily_durations(runs: DataFrame) -> DataFrame:
    """(pipeline, run_date, seconds, runs): the exact histogram."""
    return runs.groupBy(*DAY, run_seconds().alias("seconds")).agg(F.count(F.lit(1)).alias("runs"))


def _windowed(daily: DataFrame, cfg: Config, days: int) -> DataFrame:
    """Each row once for every window that its day is in."""
    last = F.least(F.date_add("run_date", days - 1), date_literal(cfg.as_of_date))
    return daily.filter(F.col("run_date") <= date_literal(cfg.as_of_date)).withColumn("window_end", F.explode(F.sequence("run_date", last))).drop("run_date")


def sketched_percentiles(sketches: DataFrame, cfg: Config, days: int = 7, probabilities: dict[str, float] = PROBABILITIES) -> DataFrame:
    """(pipeline, window_end, runs, a column of seconds per probability) by
    merging one sketch per pipeline and day."""
    merged = _windowed(sketches, cfg, days).groupBy(*WINDOW).agg(F.sum("runs").alias("runs"), F.kll_merge_agg_bigint("sketch").alias("_sketch"))
    return merged.select(*WINDOW, "runs", *[F.kll_sketch_get_quantile_bigint("_sketch", F.lit(p)).alias(name) for name, p in probabilities.items()])


def exact_sliding_percentiles(histogram: DataFrame, cfg: Config, days: int = 7, probabilities: dict[str, float] = PROBABILITIES) -> DataFrame:
    """The same from the exact histogram, interpolated between neighbours."""
    each = _windowed(histogram, cfg, days)
    return exact_percentiles(each, WINDOW, "seconds", list(probabilities.values()), list(probabilities), weight_col="runs").withColumnRenamed("n", "runs")


def sketch_errors(sketched: DataFrame, histogram: DataFrame, cfg: Config, days: int = 7, probabilities: dict[str, float] = PROBABILITIES) -> DataFrame:
    """(pipeline, window_end, rank_error): how far the worst of a window's
    sketched percentiles is from its rank, as a share of the window's runs."""
    each = _windowed(histogram, cfg, days).select(*[F.col(c).alias(f"_h_{c}") for c in WINDOW], "seconds", F.col("runs").alias("_n"))
    same = reduce(lambda a, b: a & b, [sketched[c].eqNullSafe(each[f"_h_{c}"]) for c in WINDOW])
    below = {name: (F.sum(F.when(F.col("seconds") < F.col(name), F.col("_n")).otherwise(0)), F.sum(F.when(F.col("seconds") <= F.col(name), F.col("_n")).otherwise(0))) for name in probabilities}
    counted = sketched.join(each, same).groupBy(*WINDOW).agg(F.max("runs").alias("_all"), *[c.alias(f"_{name}{i}") for name, pair in below.items() for i, c in enumerate(pair)])
    # a value covers the ranks from the runs below it to those up to it
    errors = [F.greatest(F.lit(0.0), F.col(f"_{name}0") / F.col("_all") - F.lit(p), F.lit(p) - F.col(f"_{name}1") / F.col("_all")) for name, p in probabilities.items()]
    return counted.select(*WINDOW, reduce(F.greatest, errors).alias("rank_error"))


def sliding_percentiles(sketches: DataFrame, histogram: DataFrame, cfg: Config, days: int = 7) -> DataFrame:
    """Exact percentiles in minutes of each window, and whether those of the
    sketches are within their stated error."""
    exact = exact_sliding_percentiles(histogram, cfg, days)
    errors = sketch_errors(sketched_percentiles(sketches, cfg, days), histogram, cfg, days).select(*[F.col(c).alias(f"_e_{c}") for c in WINDOW], "rank_error")
    same = reduce(lambda a, b: a & b, [exact[c].eqNullSafe(errors[f"_e_{c}"]) for c in WINDOW])
    minutes: Sequence = [(F.col(name) / F.lit(60.0)).alias(f"{name}_minutes") for name in PROBABILITIES]
    return exact.join(errors, same).select(*WINDOW, "runs", *minutes, (F.col("rank_error") <= F.lit(rank_error())).alias("sketch_within_error"))
