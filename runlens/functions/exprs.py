"""Column expressions shared by the operators.

All of them are built-in Spark expressions, so they stay inside
whole-stage code generation; nothing here is a Python UDF.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens import schema as S


def duration_minutes(start: str | Column, end: str | Column) -> Column:
    """Whole-second span in minutes.  Each endpoint is floored to the second
    first, so 0.9 s -> 7.0 s counts as 7 s (``unix_timestamp`` semantics)."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(60)


def run_seconds(start: str = "run_start", end: str = "run_end") -> Column:
    """Whole-second run span: the exact integer behind ``duration_minutes``."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


_EXACT = "decimal(38,0)"


def mean_minutes(secs: Column | None = None) -> Column:
    """Aggregate: mean duration in minutes from the exact integer sum of
    whole seconds, so the value is the same under any partitioning or
    summation order (equal to ``avg(duration_minutes)`` up to rounding)."""
    s = run_seconds() if secs is None else secs
    return F.sum(s) / F.count(s) / F.lit(60.0)


def stddev_minutes(secs: Column | None = None) -> Column:
    """Aggregate: sample standard deviation in minutes from exact integer
    sums (n, sum, sum of squares); null for fewer than two values."""
    s = run_seconds() if secs is None else secs
    n = F.count(s)
    s1 = F.sum(s).cast(_EXACT)
    s2 = F.sum(s.cast(_EXACT) * s.cast(_EXACT))
    num = n.cast(_EXACT) * s2 - s1 * s1
    return F.when(n > 1, F.sqrt(num.cast("double") / (n * (n - F.lit(1))).cast("double")) / F.lit(60.0))


def linear_fit_minutes(x: Column, secs: Column | None = None) -> tuple[Column, Column]:
    """Aggregates: least-squares slope (minutes per unit of ``x``) and
    intercept (minutes) of duration against integer ``x``, from exact
    integer sums; null when ``x`` does not vary (as ``regr_slope``)."""
    s = run_seconds() if secs is None else secs
    n = F.count(s).cast(_EXACT)
    sx = F.sum(x).cast(_EXACT)
    sy = F.sum(s).cast(_EXACT)
    sxx = F.sum(x.cast(_EXACT) * x.cast(_EXACT))
    sxy = F.sum(x.cast(_EXACT) * s.cast(_EXACT))
    den = n * sxx - sx * sx
    slope = F.when(den != 0, (n * sxy - sx * sy).cast("double") / den.cast("double") / F.lit(60.0))
    intercept = F.when(den != 0, (sy * sxx - sx * sxy).cast("double") / den.cast("double") / F.lit(60.0))
    return slope, intercept


def count_where(pred: Column) -> Column:
    """Conditional count; 0 (not null) for an empty group."""
    return F.count_if(pred)


def level_is(level: str) -> Column:
    return F.col("level") == F.lit(level)


def status_is(status: str) -> Column:
    return F.col("status") == F.lit(status)


def run_status(error_count: Column, total_events: Column, incomplete_below: int) -> Column:
    """Any error -> FAILED; else too few events -> INCOMPLETE; else SUCCESS."""
    return (
        F.when(error_count > 0, F.lit(S.STATUS_FAILED))
        .when(total_events < incomplete_below, F.lit(S.STATUS_INCOMPLETE))
        .otherwise(F.lit(S.STATUS_SUCCESS))
    )


def ratio(num: str | Column, den: str | Column) -> Column:
    """long / long -> double.  Every denominator used is a group count >= 1."""
    return F.col(num) / F.col(den) if isinstance(num, str) else num / den


def earliest_non_null(value: str, ts: str = "timestamp") -> Column:
    """Aggregate: ``(ts, value)`` struct of the earliest event whose value is
    not null, ties broken by the value.  ``min`` ignores the null structs,
    and two such structs merge with ``min`` again, so the result is
    deterministic and can be combined across batches."""
    v = F.col(value)
    return F.min(F.when(v.isNotNull(), F.struct(F.col(ts).alias("ts"), v.alias("v"))))



def error_signature(msg: str | Column) -> Column:
    """Message with each run of digits replaced by ``#``."""
    m = F.col(msg) if isinstance(msg, str) else msg
    return F.regexp_replace(m, "[0-9]+", "#")


def time_literal(value: dt.datetime, like: T.DataType) -> Column:
    """A timestamp literal typed like the column it is compared with, so an
    NTZ column is compared as NTZ and an LTZ column in the session zone."""
    text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(like, T.TimestampNTZType):
        return F.lit(text).cast(T.TimestampNTZType())
    return F.lit(text).cast(T.TimestampType())


def date_literal(value: dt.date) -> Column:
    return F.lit(value.isoformat()).cast(T.DateType())
