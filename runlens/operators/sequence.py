"""Per-group row numbers and trailing means without one task per group.

``row_number().over(Window.partitionBy(g).orderBy(t))`` sends a whole
group to one task.  When one pipeline owns a third of all runs that task
holds a third of the table.  Here:

1. one global sort by (group, order) range-partitions the rows, so a hot
   group is spread over many partitions;
2. each row gets (partition id, monotonically increasing id) and that
   numbered table is checkpointed, which fixes the ids once and cuts the
   lineage;
3. per (partition, group) block: row count and first id.  A window over
   these blocks (at most one row per partition per group) gives each
   block's offset inside its group;
4. row number = block offset + (id - first id of the block).

Trailing statistics over the ``k`` preceding rows are then an equi-join
on (group, row number): each row sends its value forward to the next
``k`` positions and the receiving side aggregates, so no key is hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.session import ensure_checkpoint_dir


def _null_safe_on(left: DataFrame, right: DataFrame, cols: Sequence[str], prefix: str) -> Column:
    cond = None
    for c in cols:
        e = left[c].eqNullSafe(right[f"{prefix}{c}"])
        cond = e if cond is None else cond & e
    return cond


def number_within(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column | str], name: str = "rn") -> DataFrame:
    """``df`` plus ``name``: 0-based position of the row inside its group in
    the given order (the order must be total for a deterministic result)."""
    ensure_checkpoint_dir(df.sparkSession)
    g = list(group_cols)
    order = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in [*g, *order_cols]]
    tagged = (
        df.orderBy(*order)
        .select("*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid"))
        .checkpoint(eager=True)
    )
    blocks = tagged.groupBy("_pid", *g).agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_m0"))
    before = Window.partitionBy(*g).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        F.col("_pid").alias("_b_pid"),
        *[F.col(c).alias(f"_b_{c}") for c in g],
        "_m0",
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
    )
    cond = (tagged["_pid"] == blocks["_b_pid"]) & _null_safe_on(tagged, blocks, g, "_b_")
    joined = tagged.join(blocks, cond, "inner")
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns],
        (F.col("_off") + F.col("_mid") - F.col("_m0")).alias(name),
    )


def running_totals(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column | str], value_cols: Sequence[str], prefix: str = "run_") -> DataFrame:
    """``df`` plus, for each value column, the sum over the rows of the group
    up to this one.  As in ``number_within`` a block holds the group's rows of
    one partition; blocks are summed on their own and start from the totals of
    the blocks before."""
    ensure_checkpoint_dir(df.sparkSession)
    g = list(group_cols)
    order = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in [*g, *order_cols]]
    tagged = df.orderBy(*order).select("*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid")).checkpoint(eager=True)
    inside = Window.partitionBy("_pid", *g).orderBy("_mid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = tagged.select("*", *[F.sum(c).over(inside).alias(f"_in_{c}") for c in value_cols])
    before = Window.partitionBy(*g).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    blocks = tagged.groupBy("_pid", *g).agg(*[F.sum(c).alias(f"_sum_{c}") for c in value_cols])
    blocks = blocks.select(
        F.col("_pid").alias("_b_pid"),
        *[F.col(c).alias(f"_b_{c}") for c in g],
        *[F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in value_cols],
    )
    cond = (summed["_pid"] == blocks["_b_pid"]) & _null_safe_on(summed, blocks, g, "_b_")
    return summed.join(blocks, cond).select(*[F.col(f"`{c}`") for c in df.columns], *[(F.col(f"_in_{c}") + F.col(f"_off_{c}")).alias(f"{prefix}{c}") for c in value_cols])


def trailing_stats(
    numbered: DataFrame,
    group_cols: Sequence[str],
    value_col: str,
    k: int,
    rn: str = "rn",
) -> DataFrame:
    """``numbered`` plus ``prev_n`` (rows among the ``k`` preceding ones) and
    ``prev_sum`` (sum of ``value_col`` over them); null sum if none."""
    g = list(group_cols)
    sent = numbered.select(
        *[F.col(c).alias(f"_s_{c}") for c in g],
        F.col(rn).alias("_from"),
        F.explode(F.sequence(F.lit(1), F.lit(k))).alias("_lag"),
        F.col(value_col).alias("_v"),
    ).withColumn("_target", F.col("_from") + F.col("_lag"))
    recv = sent.groupBy(*[f"_s_{c}" for c in g], "_target").agg(
        F.count("_v").alias("prev_n"), F.sum("_v").alias("prev_sum")
    )
    cond = (numbered[rn] == recv["_target"]) & _null_safe_on(numbered, recv, g, "_s_")
    out = numbered.join(recv, cond, "left")
    return out.select(
        *[F.col(f"`{c}`") for c in numbered.columns],
        F.coalesce(F.col("prev_n"), F.lit(0)).alias("prev_n"),
        F.col("prev_sum"),
    )
