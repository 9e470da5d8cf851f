"""Event logs derived from the driver's ``events`` table.

The reference reads real pipeline event logs; the test data has none, so
three logs of unequal schema are derived from ``events`` by the rule of
FIXTURES.md §2.  Everything is a projection of one scan per log, so the
logs grow with ``events`` and keep its partitioning.

Log 1 lacks ``origin.batch_id`` and log 2 carries an extra top-level
``details`` column: consolidation has to null-fill at both depths.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from runlens.config import Config
from runlens.sources.logs import LogSource

# The day after the last event of the test data.
FIXTURE_AS_OF = dt.datetime(2024, 1, 31)


def fixture_config(as_of: dt.datetime = FIXTURE_AS_OF, **settings) -> Config:
    return Config(as_of, **settings)


# Fixed values of the fixture rule (FIXTURES.md §2).
N_PIPES = 12          # p = user_id % 12
RUN_BUCKET = 96       # b = floor(event_id / 96)
N_LOGS = 3            # log index = p % 3
N_NAMES = 10          # pipeline_name = 'pipe_' || (p % 10)
NULL_MESSAGE_EVERY = 97
NULL_PIPELINE_EVERY = 50
NULL_UPDATE_EVERY = 41
NO_CLUSTER_PIPE = 11
N_CLUSTERS = 3
N_FLOWS = 5
MESSAGE_CODES = 7
BATCH_WIDTH = 10


def _log_exprs(k: int) -> list[str]:
    """SQL select list of fixture log ``k`` over ``events`` (one
    ``selectExpr`` per log keeps plan construction to a few calls)."""
    p = f"(user_id % {N_PIPES})"
    b = f"floor(event_id / {RUN_BUCKET})"
    origin = [
        f"'pipeline_id', CASE WHEN event_id % {NULL_PIPELINE_EVERY} = 0 THEN NULL ELSE concat('p', CAST({p} AS STRING)) END",
        f"'pipeline_name', concat('pipe_', CAST({p} % {N_NAMES} AS STRING))",
        f"'pipeline_type', CASE WHEN {p} % 2 = 0 THEN 'WORKSPACE' ELSE 'TABLE' END",
        f"'update_id', CASE WHEN event_id % {NULL_UPDATE_EVERY} = 0 THEN NULL "
        f"ELSE concat('u', CAST({p} AS STRING), '-', CAST({b} AS STRING)) END",
        f"'flow_id', concat('fl', CAST(event_id % {N_FLOWS} AS STRING))",
        f"'flow_name', concat('flow_', CAST(event_id % {N_FLOWS} AS STRING))",
        f"'cluster_id', CASE WHEN {p} = {NO_CLUSTER_PIPE} THEN NULL ELSE concat('c', CAST({b} % {N_CLUSTERS} AS STRING)) END",
    ]
    if k != 1:  # log 1 lacks origin.batch_id
        origin.append(f"'batch_id', CAST(floor(event_id / {BATCH_WIDTH}) AS STRING)")
    origin.append("'request_id', concat('r', CAST(event_id AS STRING))")
    exprs = [
        "event_id AS id",
        "ts AS timestamp",
        "event_type",
        "CASE WHEN (event_type = 'error' AND value > 60) OR (event_type = 'purchase' AND value > 150) THEN 'ERROR' "
        "WHEN event_type = 'signup' AND value > 40 THEN 'WARN' "
        "WHEN event_type = 'view' AND value < 5 THEN 'METRICS' ELSE 'INFO' END AS level",
        f"CASE WHEN event_id % {NULL_MESSAGE_EVERY} = 0 THEN NULL "
        f"ELSE concat(event_type, ' code ', CAST(event_id % {MESSAGE_CODES} AS STRING)) END AS message",
        "named_struct(" + ", ".join(origin) + ") AS origin",
    ]
    if k == 2:  # log 2 carries an extra top-level column
        exprs.append("props AS details")
    return exprs


def log_names(k: int) -> tuple[str, str, str]:
    """(catalog, schema, table) of fixture log ``k``: three logs, two catalogs."""
    return f"cat{k % 2}", f"s{k}", f"event_log_{k}"


def event_logs(events: DataFrame) -> list[LogSource]:
    """Split ``events`` into the three fixture event logs."""
    logs = []
    for k in range(N_LOGS):
        catalog, schema, table = log_names(k)
        df = events.where(f"coalesce(user_id % {N_PIPES} % {N_LOGS}, 0) = {k}").selectExpr(*_log_exprs(k))
        logs.append(LogSource(catalog, schema, table, df))
    return logs


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def fixture_logs(spark: SparkSession, sf_dir: str) -> list[LogSource]:
    return event_logs(read_events(spark, sf_dir))


FIXTURE_SCHEMA_PREFIX = "runlens_fx_s"
SOURCE_PROPERTY = "runlens.source"


def fixture_database(k: int) -> str:
    """Session-catalog schema holding fixture log ``k``."""
    return f"{FIXTURE_SCHEMA_PREFIX}{k}"


def _registered_source(spark: SparkSession, name: str) -> str | None:
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return next((r["value"] for r in rows if r["key"] == SOURCE_PROPERTY), None)


def register_fixture_tables(spark: SparkSession, sf_dir: str) -> list[tuple[str, str, str]]:
    """Write the fixture logs of ``sf_dir`` as catalog tables
    ``spark_catalog.runlens_fx_s<k>.event_log_<k>`` under the shared
    checkpoint folder (once per session and data folder; the folder is kept
    as a table property), plus a non-matching table and a temporary view
    that discovery must skip.  Returns (catalog, schema, table) of the logs."""
    from runlens.session import new_scratch
    from runlens.sources.logs import quote

    out = []
    root = None
    for k, log in enumerate(fixture_logs(spark, sf_dir)):
        db = fixture_database(k)
        name = f"{quote(db)}.{quote(log.table)}"
        if _registered_source(spark, name) != sf_dir:
            root = root or new_scratch(spark, "fixture-tables")
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quote(db)} LOCATION '{root}/{db}'")
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            log.df.write.format("parquet").option("path", f"{root}/{db}/{log.table}").saveAsTable(name)
            literal = sf_dir.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{SOURCE_PROPERTY}' = '{literal}')")
            if k == 0:
                read_events(spark, sf_dir).select("event_id").limit(0).write.mode("overwrite").format(
                    "parquet"
                ).option("path", f"{root}/{db}/orders").saveAsTable(f"{quote(db)}.`orders`")
        out.append(("spark_catalog", db, log.table))
    read_events(spark, sf_dir).limit(0).createOrReplaceTempView("event_log_tmp")
    return out
