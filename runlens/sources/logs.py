"""Reading event logs and stacking them into one consolidated table.

Logs of different pipelines (and platform versions) differ in schema.
Instead of relying on ``unionByName(allowMissingColumns=True)`` to rebuild
``origin`` after the union (which blocks the nested not-null filter from
reaching the scans), every log is first projected onto one common schema:
the union of all top-level columns, with ``origin`` widened to the union of
all its fields.  The union is then a plain n-ary ``Union`` of identically
typed branches, so Catalyst pushes the time filter and the
``origin.pipeline_id IS NOT NULL`` filter into every log's scan.

Columns are matched without regard to case, and types are widened where that
loses nothing (int to bigint, float to double, decimals).  Any other clash
(e.g. ``id`` bigint in one log and string in another, or ``origin`` a struct
in one and a string in another) is raised up front as ``SchemaClashError``
naming the logs, instead of failing mid-job.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens import schema as S
from runlens.config import Config
from runlens.functions.exprs import time_literal


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class LogSource:
    catalog: str
    schema: str
    table: str
    df: DataFrame

    @property
    def full_name(self) -> str:
        return f"{self.catalog}.{self.schema}.{self.table}"

    @property
    def quoted_name(self) -> str:
        return ".".join(quote(p) for p in (self.catalog, self.schema, self.table))


def read_log(spark: SparkSession, catalog: str, schema: str, table: str) -> LogSource:
    """Scan one catalog table by name (identifiers back-quoted)."""
    name = ".".join(quote(p) for p in (catalog, schema, table))
    return LogSource(catalog, schema, table, spark.table(name))


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def widened(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds all values of both without loss, or None."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    kinds = (type(a), type(b))
    if all(k in _WHOLE for k in kinds):
        return max((a, b), key=lambda t: _WHOLE.index(type(t)))
    if set(kinds) == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if set(kinds) <= {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    digits = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
    if T.DecimalType in kinds and all(k is T.DecimalType or k in digits for k in kinds):
        whole = max(t.precision - t.scale if isinstance(t, T.DecimalType) else digits[type(t)] for t in (a, b))
        scale = max(t.scale if isinstance(t, T.DecimalType) else 0 for t in (a, b))
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    if all(k in (T.ByteType, T.ShortType, T.IntegerType, T.FloatType, T.DoubleType) for k in kinds):
        return T.DoubleType()  # 32 bits fit a double
    return None


class _Columns:
    """Columns seen so far, in first-seen order; names without regard to case."""

    def __init__(self, what: str):
        self.what = what
        self.seen: dict[str, tuple[str, T.DataType, str]] = {}

    def add(self, name: str, kind: T.DataType, where: str) -> None:
        key = name.lower()
        if key not in self.seen:
            self.seen[key] = (name, kind, where)
            return
        first, have, origin = self.seen[key]
        wide = widened(have, kind)
        if wide is None:
            raise S.SchemaClashError(f"{self.what}{first} is {have.simpleString()} in {origin} but {kind.simpleString()} in {where}")
        self.seen[key] = (first, wide, where if isinstance(have, T.NullType) else origin)

    def fields(self) -> list[T.StructField]:
        return [T.StructField(n, t, True) for n, t, _ in self.seen.values()]


def common_schema(logs: list[LogSource]) -> T.StructType:
    """Union of all columns (first-seen order), types widened without loss;
    ``origin`` widened field by field."""
    top, origin = _Columns("column "), _Columns("origin.")
    for f in S.ORIGIN_FIELDS:
        origin.add(f, T.StringType(), "declared")
    order: list[str] = []
    for log in logs:
        for fld in log.df.schema.fields:
            if fld.name.lower() not in order:
                order.append(fld.name.lower())
            if fld.name.lower() != "origin":
                top.add(fld.name, fld.dataType, log.full_name)
                continue
            if not isinstance(fld.dataType, T.StructType):
                raise S.SchemaClashError(f"column origin is {fld.dataType.simpleString()} in {log.full_name}; a struct is required")
            for sub in fld.dataType.fields:
                if sub.name.lower() not in S.ORIGIN_FIELDS:
                    origin.add(sub.name, sub.dataType, log.full_name)
                elif isinstance(sub.dataType, (T.StructType, T.ArrayType, T.MapType)):  # declared fields are read as strings
                    raise S.SchemaClashError(f"origin.{sub.name} is {sub.dataType.simpleString()} in {log.full_name}; expected a scalar")
    missing = [c for c in S.REQUIRED_COLUMNS if c != "origin" and c not in top.seen]
    if missing:
        raise S.SchemaClashError(f"no log provides required column(s) {missing}")
    for name, allowed in S.REQUIRED_COLUMNS.items():
        if name in top.seen and not isinstance(top.seen[name][1], (*allowed, T.NullType)):
            _, kind, where = top.seen[name]
            raise S.SchemaClashError(f"column {name} is {kind.simpleString()} in {where}; expected {' or '.join(a.typeName() for a in allowed)}")
    fields = {f.name.lower(): f for f in top.fields()}
    fields["origin"] = T.StructField("origin", T.StructType(origin.fields()), True)
    # required columns go by their declared names
    named = [T.StructField(key if key in S.REQUIRED_COLUMNS else f.name, f.dataType, True) for key, f in ((k, fields[k]) for k in [*order, *(["origin"] if "origin" not in order else [])])]
    return T.StructType(named)


def aligned_columns(schema: T.StructType, target: T.StructType) -> list[str]:
    """SQL select list that turns columns of ``schema`` into those of ``target``:
    same order and names, missing columns and missing ``origin`` fields as typed
    nulls, others cast to the target's type."""
    have = {f.name.lower(): f for f in schema.fields}
    exprs: list[str] = []
    for fld in target.fields:
        q, t = quote(fld.name), fld.dataType.simpleString()
        own = have.get(fld.name.lower())
        if fld.name == "origin":
            sub_have = {f.name.lower(): f for f in own.dataType.fields} if own else {}
            parts = []
            for sub in fld.dataType.fields:
                st = sub.dataType.simpleString()
                mine = sub_have.get(sub.name.lower())
                if mine is None:
                    v = f"CAST(NULL AS {st})"
                else:
                    v = f"{quote(own.name)}.{quote(mine.name)}"
                    v = v if mine.dataType == sub.dataType else f"CAST({v} AS {st})"
                name = sub.name.replace("\\", "\\\\").replace("'", "\\'")
                parts.append(f"'{name}', {v}")
            exprs.append(f"named_struct({', '.join(parts)}) AS origin")
        elif own is None:
            exprs.append(f"CAST(NULL AS {t}) AS {q}")
        elif own.dataType != fld.dataType:
            exprs.append(f"CAST({quote(own.name)} AS {t}) AS {q}")
        else:
            exprs.append(f"{quote(own.name)} AS {q}")
    return exprs


def align(df: DataFrame, target: T.StructType) -> DataFrame:
    """Project ``df`` onto ``target`` (one select list, so that building it
    costs one call)."""
    return df.selectExpr(*aligned_columns(df.schema, target))


def with_source(log: LogSource, df: DataFrame) -> DataFrame:
    def s(v: str) -> str:
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"

    return df.selectExpr(
        "*",
        f"{s(log.catalog)} AS source_catalog",
        f"{s(log.schema)} AS source_schema",
        f"{s(log.table)} AS source_table",
        f"{s(log.full_name)} AS source_full_name",
    )


def consolidate(logs: list[LogSource], cfg: Config) -> DataFrame:
    """Stack all logs into one DataFrame with source columns and a load stamp.

    Bag union: an event present in two logs is kept twice.  The time cutoff
    (``timestamp >= as_of - days_back``, inclusive; null timestamps drop out)
    is applied per log, so it reaches each log's scan as a pushed filter.
    """
    if not logs:
        raise ValueError("no event logs to consolidate")
    target = common_schema(logs)
    ts_type = target["timestamp"].dataType
    stamp = time_literal(cfg.time, T.TimestampNTZType())
    parts = []
    for log in logs:
        df = with_source(log, align(log.df, target))
        if cfg.cutoff is not None:
            df = df.filter(F.col("timestamp") >= time_literal(cfg.cutoff, ts_type))
        parts.append(df.withColumn(S.LOAD_STAMP, stamp))
    return reduce(DataFrame.union, parts)
