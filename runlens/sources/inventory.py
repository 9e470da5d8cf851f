"""Discovery of event-log tables in the catalogs.

Listing catalogs, schemas and tables is metadata work: each ``SHOW``
returns a few names to the driver, as with any catalog API.  Data work
(row counts) is one Spark job over all discovered logs, not one per table.

Semantics kept from the reference: an explicit catalog list skips the
catalog regex and system-catalog exclusion; the schema regex always
applies; regexes are start-anchored matches; table names are matched by a
lower-cased substring.  Unlike the reference, temporary views are
skipped, identifiers are back-quoted (hyphens work), and a table that
cannot be read is reported with ``status = 'error'`` instead of vanishing.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens import schema as S
from runlens.config import THRESHOLDS, Config
from runlens.sources.logs import LogSource, quote

INVENTORY_SCHEMA = T.StructType(
    [
        T.StructField("catalog", T.StringType(), False),
        T.StructField("schema", T.StringType(), False),
        T.StructField("table", T.StringType(), False),
        T.StructField("full_name", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("reason", T.StringType(), True),
    ]
)


def _match(pattern: str | None, name: str) -> bool:
    return pattern is None or re.match(pattern, name) is not None


def _first_present(columns: list[str], *candidates: str) -> str:
    for c in candidates:
        if c in columns:
            return c
    return columns[0]


def list_catalogs(spark: SparkSession, cfg: Config) -> list[str]:
    if cfg.target_catalogs:
        return list(cfg.target_catalogs)
    names = [c.name for c in spark.catalog.listCatalogs()]
    if not cfg.include_system_catalogs:
        names = [n for n in names if n not in S.SYSTEM_CATALOGS]
    return [n for n in names if _match(cfg.catalog_filter, n)]


def list_schemas(spark: SparkSession, catalog: str) -> list[str]:
    """Schema names of a catalog; falls back to the catalog's
    ``information_schema`` where ``SHOW SCHEMAS`` is not supported."""
    try:
        df = spark.sql(f"SHOW SCHEMAS IN {quote(catalog)}")
        col = _first_present(df.columns, "namespace", "schemaName", "databaseName")
    except Exception:  # noqa: BLE001 - try the other listing before giving up
        df = spark.sql(f"SELECT DISTINCT schema_name FROM {quote(catalog)}.information_schema.schemata")
        col = "schema_name"
    return [r[col] for r in df.collect()]


def list_tables(spark: SparkSession, catalog: str, schema: str) -> list[str]:
    df = spark.sql(f"SHOW TABLES IN {quote(catalog)}.{quote(schema)}")
    if "isTemporary" in df.columns:
        df = df.filter(~F.col("isTemporary"))
    col = _first_present(df.columns, "tableName", "name", "table")
    return [r[col] for r in df.collect()]


def discover(spark: SparkSession, cfg: Config | None = None) -> DataFrame:
    """Inventory of event-log tables: catalog, schema, table, full_name,
    status ('ok' / 'error'), reason."""
    cfg = cfg or THRESHOLDS
    pattern = cfg.log_name_pattern.lower()
    rows = []
    for catalog in list_catalogs(spark, cfg):
        try:
            schemas = list_schemas(spark, catalog)
        except Exception as e:  # noqa: BLE001 - reported as a row
            rows.append((catalog, "", "", catalog, "error", f"cannot list schemas: {str(e)}"))
            continue
        for schema in schemas:
            if not _match(cfg.schema_filter, schema):
                continue
            try:
                tables = list_tables(spark, catalog, schema)
            except Exception as e:  # noqa: BLE001
                rows.append((catalog, schema, "", f"{catalog}.{schema}", "error", f"cannot list tables: {str(e)}"))
                continue
            for table in tables:
                if pattern not in table.lower():
                    continue
                full = f"{catalog}.{schema}.{table}"
                try:
                    spark.table(".".join(quote(p) for p in (catalog, schema, table))).schema  # analysis only
                    rows.append((catalog, schema, table, full, "ok", None))
                except Exception as e:  # noqa: BLE001
                    rows.append((catalog, schema, table, full, "error", str(e)))
    return spark.createDataFrame(rows, INVENTORY_SCHEMA)


def readable_logs(spark: SparkSession, inventory: DataFrame) -> list[LogSource]:
    """LogSources for the 'ok' rows of an inventory (a few names only)."""
    out = []
    for r in inventory.filter(F.col("status") == "ok").select("catalog", "schema", "table").collect():
        name = ".".join(quote(p) for p in (r["catalog"], r["schema"], r["table"]))
        out.append(LogSource(r["catalog"], r["schema"], r["table"], spark.table(name)))
    return out


def log_row_counts(logs: list[LogSource]) -> DataFrame:
    """Row count of every log, empty ones included, in one job with one
    exchange: a tagged union under one ``groupBy``."""
    names = "catalog string, schema string, `table` string, full_name string"
    spark = logs[0].df.sparkSession
    known = spark.createDataFrame([(i, x.catalog, x.schema, x.table, x.full_name) for i, x in enumerate(logs)], f"_log int, {names}")
    tagged = reduce(DataFrame.union, [x.df.select(F.lit(i).alias("_log"), F.lit(1).alias("_n")) for i, x in enumerate(logs)])
    zeros = known.select("_log", F.lit(0).alias("_n"))
    counts = tagged.union(zeros).groupBy("_log").agg(F.sum("_n").cast("long").alias("row_count"))
    return known.join(counts, "_log").drop("_log")


def inventory_with_counts(spark: SparkSession, inventory: DataFrame) -> DataFrame:
    """The inventory plus ``row_count`` of every readable log (one counting
    job for all logs; null for rows with status 'error')."""
    logs = readable_logs(spark, inventory)
    if not logs:
        return inventory.withColumn("row_count", F.lit(None).cast("long"))
    counts = log_row_counts(logs).select(F.col("full_name").alias("_fn"), "row_count")
    # both sides hold one row per table: AQE broadcasts after measuring
    return inventory.join(counts, inventory["full_name"] == counts["_fn"], "left").drop("_fn")


def inventory_by_catalog(counts: DataFrame) -> DataFrame:
    """Per catalog: number of logs and their total rows."""
    return counts.groupBy("catalog").agg(
        F.count(F.lit(1)).alias("table_count"), F.sum("row_count").alias("total_rows")
    )
