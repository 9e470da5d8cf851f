"""Exact interpolated percentiles per group without one task per group.

``percentile(x, p)`` (and a window over the group) holds every value of a
group in one task; a pipeline with a third of all runs would then sit in a
single task.  Here the values are first counted per (group, value) with
map-side partial aggregation, so each group shrinks to its *distinct*
values (run durations are whole seconds, so this is bounded by the longest
run, not by the number of runs).  A running count over that histogram
locates the two order statistics around position ``(n - 1) * p`` and the
result is interpolated linearly, the same definition as Spark's
``percentile`` and SQL ``quantile_cont``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runlens.session import ensure_checkpoint_dir


def _label(p: float) -> str:
    return "p" + f"{p:.4f}".rstrip("0").rstrip(".").replace("0.", "", 1).replace(".", "_")


def exact_percentiles(
    df: DataFrame,
    group_cols: Sequence[str],
    value_col: str,
    probs: Sequence[float],
    names: Sequence[str] | None = None,
    weight_col: str | None = None,
) -> DataFrame:
    """One row per group: ``n`` and one column per probability; with
    ``weight_col`` a row stands for so many values."""
    names = list(names or [_label(p) for p in probs])
    g = list(group_cols)
    hist = (
        df.filter(F.col(value_col).isNotNull())
        .groupBy(*g, value_col)
        .agg((F.sum(weight_col) if weight_col else F.count(F.lit(1))).alias("_cnt"))
    )
    # running counts by blocks: the histogram is sorted over all partitions,
    # counted within each (partition, group) block, and each block starts at
    # the sum of the group's earlier ones (one row per partition and group)
    ensure_checkpoint_dir(df.sparkSession)
    hist = hist.orderBy(*[F.col(c).asc_nulls_first() for c in g], value_col).withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    sums = hist.groupBy("_pid", *g).agg(F.sum("_cnt").alias("_block"))
    group = Window.partitionBy(*g)
    earlier = group.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("_pid").alias("_b_pid"),
        *[F.col(c).alias(f"_b_{c}") for c in g],
        F.coalesce(F.sum("_block").over(earlier), F.lit(0)).alias("_off"),
        F.sum("_block").over(group).alias("n"),
    )
    same = reduce(lambda x, y: x & y, [hist[c].eqNullSafe(sums[f"_b_{c}"]) for c in g], hist["_pid"] == sums["_b_pid"])
    within = Window.partitionBy("_pid", *g).orderBy(value_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.col("_off") + F.sum("_cnt").over(within)
    cum = hist.join(sums, same).select(*g, value_col, (upto - F.col("_cnt")).alias("_lo"), upto.alias("_hi"), "n")
    picks = []
    for i, p in enumerate(probs):
        pos = (F.col("n") - 1) * F.lit(float(p))
        r1 = F.floor(pos)
        r2 = F.least(r1 + 1, F.col("n") - 1)
        cum = cum.withColumn(f"_f{i}", pos - r1)
        picks += [
            F.max(F.when((F.col("_lo") <= r1) & (r1 < F.col("_hi")), F.col(value_col))).alias(f"_a{i}"),
            F.max(F.when((F.col("_lo") <= r2) & (r2 < F.col("_hi")), F.col(value_col))).alias(f"_b{i}"),
            F.max(f"_f{i}").alias(f"_ff{i}"),
        ]
    agg = cum.groupBy(*g).agg(F.max("n").alias("n"), *picks)
    out = [F.col(c) for c in g] + [F.col("n")]
    for i, name in enumerate(names):
        a, b, f = F.col(f"_a{i}"), F.col(f"_b{i}"), F.col(f"_ff{i}")
        out.append((a + f * (b - a)).cast("double").alias(name))
    return agg.select(*out)
