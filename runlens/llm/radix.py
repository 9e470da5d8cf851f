"""Ranks by a distributed least-significant-digit radix sort.

Rows lie in blocks of bounded size, each row at a place.  A pass is a stable
counting sort on one digit of the key: the rows of each (digit, block) are
counted, global prefix sums give each pair the place of its first row, and a
block's rows then know their new places, which give their new blocks.  After
the last digit a row's place is its rank.  A digit that all rows share makes
no pass.

No step holds more than a block, or a count for each digit: blocks are cut by
place, not by value, so ties and hot values can't swell one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.tables import importable, written

DIGIT_BITS = 12
BLOCK_ROWS = 1 << 17
_SIGN = -(1 << 63)


def _placed(rows: pa.Table, starts: pa.Table, base: np.ndarray, block_rows: int) -> pa.Table:
    """A block's rows at their new places."""
    first = np.zeros(len(base), dtype=np.int64)
    first[starts["digit"].to_numpy()] = starts["before"].to_numpy()
    rows = rows.take(pa.array(np.argsort(rows["place"].to_numpy())))
    digits = rows["digit"].to_numpy().astype(np.uint16)
    order = np.argsort(digits, kind="stable")
    counts = np.bincount(digits, minlength=len(base))
    nth = np.empty(len(digits), dtype=np.int64)
    nth[order] = np.arange(len(digits)) - np.repeat(np.cumsum(counts) - counts, counts)
    place = base[digits] + first[digits] + nth
    return rows.drop_columns(["digit", "block", "place"]).append_column("block", pa.array(place // block_rows)).append_column("place", pa.array(place))


def _pass(laid: DataFrame, digit, label: str) -> DataFrame:
    spark = laid.sparkSession
    importable(spark)
    digits = laid.withColumn("digit", digit.cast("int"))
    counts = digits.groupBy("digit", "block").agg(F.count(F.lit(1)).alias("n"))
    lower = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("digit", "block", F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("before"))
    base = np.zeros(1 << DIGIT_BITS, dtype=np.int64)
    for d, n in counts.groupBy("digit").agg(F.sum("n")).collect():  # a row for each digit
        base[d] = n
    base = np.cumsum(base) - base
    block_rows = BLOCK_ROWS

    def moved(rows: pa.Table, starts: pa.Table) -> pa.Table:
        return _placed(rows, starts, base, block_rows)

    out = digits.groupBy("block").cogroup(starts.groupBy("block")).applyInArrow(moved, laid.schema)
    return written(out, label)


def ranked(rows: DataFrame, by: list[str], rank: str = "rank") -> DataFrame:
    """rows with their rank 1, 2, 3... by the integer columns `by`, ascending,
    nulls last; rows that tie in all of them come in no fixed order."""
    keys = [f"__key{i}" for i in range(len(by))]
    # flipping the sign bit makes the order of signed numbers that of bits
    flipped = [F.coalesce(F.col(f"`{c}`").cast("long"), F.lit((1 << 63) - 1)).bitwiseXOR(F.lit(_SIGN)).alias(k) for c, k in zip(by, keys, strict=True)]
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("__row")
    first = rows.select(row, *flipped, F.monotonically_increasing_id().alias("place"))
    laid = written(first.select("__row", *keys, F.expr(f"place div {BLOCK_ROWS}").alias("block"), "place"), "radix")
    bits = laid.agg(*[f(F.col(k).bitwiseXOR(F.lit(_SIGN))).alias(f"{k}{f.__name__}") for k in keys for f in (F.min, F.max)]).first()
    digits = []
    for k in reversed(keys):
        low, high = bits[f"{k}min"], bits[f"{k}max"]
        width = 0 if low is None else (low ^ high).bit_length() if (low < 0) == (high < 0) else 64
        digits += [F.shiftrightunsigned(k, shift).bitwiseAND((1 << DIGIT_BITS) - 1) for shift in range(0, width, DIGIT_BITS)]
    for digit in digits or [F.lit(0)]:  # rows that all tie still get places without gaps
        laid = _pass(laid, digit, "radix")
    return laid.select(*[F.col("__row").getField(c).alias(c) for c in rows.columns], (F.col("place") + 1).alias(rank))
