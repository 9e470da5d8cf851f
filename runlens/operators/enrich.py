"""Flatten the ``origin`` struct and keep events that name a pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens import schema as S


def flatten_origin(df: DataFrame) -> DataFrame:
    """All columns plus the nine ``origin`` fields as top-level columns
    (one projection; an existing top-level column of the same name is
    replaced, as ``withColumn`` would)."""
    keep = [F.col(f"`{c}`") for c in df.columns if c not in S.ORIGIN_FIELDS]
    return df.select(*keep, *[F.col("origin").getField(f).alias(f) for f in S.ORIGIN_FIELDS])


def enrich(consolidated: DataFrame) -> DataFrame:
    """Enriched events: flattened metadata, rows without a pipeline id
    removed (they stay in the consolidated table).  The filter is written on
    the nested field so it is pushed to each log's scan."""
    return flatten_origin(consolidated.filter(F.col("origin.pipeline_id").isNotNull()))
