"""Writing result tables (full overwrite, schema replaced) and temp views.
The format is a parameter; parquet is the default."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from runlens.sources.logs import quote


def ensure_schema(spark: SparkSession, database: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {'.'.join(quote(p) for p in database.split('.'))}{loc}")


def table_name(database: str, prefix: str, key: str) -> str:
    return ".".join(quote(p) for p in database.split(".")) + "." + quote(f"{prefix}{key}")


def write_table(df: DataFrame, name: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    w = df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def register_views(results: dict[str, DataFrame], prefix: str = "evlog_") -> list[str]:
    """Temp views ``{prefix}{key}`` for SQL access; returns the view names."""
    names = []
    for key, df in results.items():
        df.createOrReplaceTempView(f"{prefix}{key}")
        names.append(f"{prefix}{key}")
    return names
