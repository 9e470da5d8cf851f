"""Sharding: a Feistel permutation of global row numbers.

Rows are numbered in the order of their columns; a keyed permutation of
0..n-1 moves each number, and the new number gives the shard (remainder) and
the slot in it (quotient).  So shard sizes differ by one row at most, slots
have no gaps, and anyone can compute a row's place, or the row of a place,
from its number alone.

The permutation is a balanced Feistel network on the least even number of
bits that holds n; numbers that leave 0..n-1 go through it again (cycle
walking), which keeps it a permutation of 0..n-1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.llm.tables import map_batches
from runlens.session import materialize

ROUNDS = 6
# Copies of one row that are spread from one place.
COPIES = 10_000


def _round_keys(seed: int) -> list[np.uint64]:
    return [np.uint64(x) for x in np.random.default_rng(seed).integers(1, 1 << 62, ROUNDS)]


def _mix(x: np.ndarray, key: np.uint64) -> np.ndarray:
    x = (x + key) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def permuted(rows: np.ndarray, n: int, seed: int, back: bool = False) -> np.ndarray:
    """Where the permutation of 0..n-1 sends each row; `back`: whence."""
    half = np.uint64(max(1, ((max(n, 2) - 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = _round_keys(seed)
    x = np.asarray(rows, dtype=np.uint64).copy()
    open_ = np.ones(len(x), dtype=bool)
    while open_.any():
        left, right = x[open_] >> half, x[open_] & mask
        for k in reversed(keys) if back else keys:
            if back:
                left, right = right ^ (_mix(left, k) & mask), left
            else:
                left, right = right, left ^ (_mix(right, k) & mask)
        x[open_] = (left << half) | right
        open_[open_] = x[open_] >= np.uint64(n)
    return x.astype(np.int64)


def numbered(rows: DataFrame, name: str = "row_number") -> tuple[DataFrame, int]:
    """rows with a column 0..n-1 in the order of all columns (nulls first),
    and n.

    Equal rows are counted before the shuffle and spread again afterwards, so
    that no task gets all copies of a row.  Rows are range-partitioned, and
    only one count for each partition meets on the driver.
    """
    by = [F.col(f"`{c}`") for c in rows.columns]
    counted = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("__copies"))
    # the checkpoint fixes which rows each partition holds, and their order
    laid = materialize(counted.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__part", F.spark_partition_id()))
    begins, total = {}, 0
    for part, n in sorted(laid.groupBy("__part").agg(F.sum("__copies")).collect()):
        begins[part], total = total, total + n

    def first_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            copies = batch.column(batch.num_columns - 2).to_numpy()
            if before is None:
                before = begins[batch.column(batch.num_columns - 1)[0].as_py()]
            ends = before + np.cumsum(copies)
            before = int(ends[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(ends - copies)], names=[*batch.schema.names[:-1], "__first"])

    fields = T.StructType([*rows.schema.fields, T.StructField("__copies", T.LongType()), T.StructField("__first", T.LongType())])
    blocks = map_batches(laid, first_numbers, fields).select(*by, (F.col("__first") + F.col("__copies")).alias("__end"), F.explode(F.expr(f"sequence(__first, __first + __copies - 1, {COPIES}L)")).alias("__first"))
    spread = blocks.repartition("__first")
    return spread.select(*by, F.explode(F.expr(f"sequence(__first, least(__first + {COPIES - 1}L, __end - 1))")).alias(name)), total


def sharded(rows: DataFrame, shards: int, seed: int = 7) -> DataFrame:
    """rows with `shard` (0..shards-1) and `slot` (0.. without a gap).

    Counts of any two shards differ by one at most.  Equal rows are
    interchangeable; null values sort first; no rows give no rows.
    """
    with_number, n = numbered(rows, "__row")

    @F.pandas_udf("long")
    def moved(row: pd.Series) -> pd.Series:
        return pd.Series(permuted(row.to_numpy(), n, seed))

    placed = with_number.withColumn("__place", moved("__row"))
    return placed.select(*[F.col(f"`{c}`") for c in rows.columns], (F.col("__place") % shards).cast("int").alias("shard"), F.expr(f"`__place` div {shards}").alias("slot"))
