"""Declared shape of an event log and of the results."""

from __future__ import annotations

from pyspark.sql import types as T

# The nine ``origin`` fields the analytics flatten, in the
# order they are exposed as top-level columns of the enriched events.
ORIGIN_FIELDS = (
    "pipeline_id",
    "pipeline_name",
    "pipeline_type",
    "update_id",
    "flow_id",
    "flow_name",
    "cluster_id",
    "batch_id",
    "request_id",
)

# Level and status labels compared with / produced by the runs fold.
LEVEL_ERROR = "ERROR"
LEVEL_WARN = "WARN"
LEVEL_INFO = "INFO"
STATUS_FAILED = "FAILED"
STATUS_INCOMPLETE = "INCOMPLETE"
STATUS_SUCCESS = "SUCCESS"

# Catalogs skipped by discovery unless asked for.
SYSTEM_CATALOGS = ("system", "information_schema", "samples")

# Columns added by consolidation.
SOURCE_COLUMNS = ("source_catalog", "source_schema", "source_table", "source_full_name")
LOAD_STAMP = "consolidated_at"

# Key of one pipeline run.
RUN_KEYS = ("pipeline_id", "pipeline_name", "update_id", "source_full_name")

# Top-level columns the analytics need; anything else rides along.
REQUIRED_COLUMNS = {
    "timestamp": (T.TimestampType, T.TimestampNTZType),
    "level": (T.StringType,),
    "event_type": (T.StringType,),
    "message": (T.StringType,),
    "origin": (T.StructType,),
}


class SchemaClashError(ValueError):
    """Two event logs declare the same column with incompatible types."""
