"""Structured Streaming refresh of the published tables.

Event-log files are read with ``readStream``; each micro-batch is aligned
and stamped with its source, then handed to ``plans.refresh.apply_events``
from ``foreachBatch``, which writes them as a segment and commits it by one row
of the manifest: exactly once per micro-batch id, since the stream's checkpoint
replays an unfinished batch after a failure and the manifest makes the
replay a no-op if the batch had already committed.  A micro-batch costs what
it holds; the published tables are derived every ``publish_every`` batches.

The batch's DataFrame belongs to a session that the stream has cloned, so all
work on it goes through that session.  Files that a rebuild has read are
skipped: a backfill followed by a monitor over the same folders counts each
event once.

Exact distinct counts and sets are not supported as streaming state, which
is why the state lives in tables of mergeable partials rather than in the
stream's own state store.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens import schema as S
from runlens.config import Config
from runlens.functions.exprs import time_literal
from runlens.plans.refresh import apply_events, current_results, publish_tables, uncovered
from runlens.plans.store import FILE_COLUMN, Store
from runlens.sources.logs import LogSource, consolidate
from runlens.sources.sinks import ensure_schema


@dataclass(frozen=True)
class StreamLog:
    """One event-log location to follow: names plus its file folder."""

    catalog: str
    schema: str
    table: str
    path: str
    schema_type: T.StructType
    fmt: str = "parquet"


def start_run_monitor(
    spark: SparkSession,
    logs: list[StreamLog],
    database: str,
    checkpoint: str,
    cfg: Config,
    location: str | None = None,
    max_files_per_trigger: int = 5,
    available_now: bool = True,
    clock: Callable[[], dt.datetime] | None = None,
    publish_every: int = 1,
):
    """Start the stream; returns the ``StreamingQuery``.

    ``checkpoint`` must be on shared storage; restarting with the same one
    resumes after the last finished micro-batch.  ``clock`` gives each batch
    its ``as_of`` (default: always that of ``cfg``).  With ``publish_every``
    above 1, call ``publish_tables`` after the stream, or read
    ``monitored_runs``, which is always current."""
    ensure_schema(spark, database, location)

    def stream(log: StreamLog) -> LogSource:
        reader = spark.readStream.schema(log.schema_type).option("maxFilesPerTrigger", max_files_per_trigger)
        df = reader.format(log.fmt).load(log.path)
        return LogSource(log.catalog, log.schema, log.table, df.select("*", F.col("_metadata.file_path").alias(FILE_COLUMN)))

    # no cutoff here: the window moves, and is applied when tables are derived
    events = consolidate([stream(log) for log in logs], replace(cfg, days_back=None))
    source = "stream_" + hashlib.sha1(checkpoint.encode()).hexdigest()[:10]

    def fold(batch: DataFrame, batch_id: int) -> None:
        now = replace(cfg, as_of=clock()) if clock else cfg
        own = batch.sparkSession
        stamped = batch.withColumn(S.LOAD_STAMP, time_literal(now.time, T.TimestampNTZType()))
        apply_events(own, uncovered(stamped, database, now, FILE_COLUMN), database, now, source, int(batch_id))
        if (int(batch_id) + 1) % publish_every == 0:
            publish_tables(own, database, now)
        Store(spark, database, now).reread()  # for readers in the caller's session

    writer = events.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def monitored_runs(spark: SparkSession, database: str, cfg: Config) -> DataFrame:
    """The runs table at ``cfg.as_of``, from what the monitor has committed."""
    return current_results(spark, database, cfg)["pipeline_runs"]
