"""Named queries: ``(spark, sf_dir) -> DataFrame`` in *report form*.

The report form is the library table with two presentation changes that
make it comparable row by row with the SQL oracle (``plans/oracle.py``):
doubles rounded to 6 places and array columns rendered as ``|``-joined
text (sets sorted, ordered lists in order).  Every query reads the whole
fixture derived from the ``events`` table of ``sf_dir``.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens import schema as S
from runlens.config import Config
from runlens.sources.fixture import fixture_config
from runlens.functions.exprs import time_literal
from runlens.operators import metrics as M
from runlens.operators import ranking as R
from runlens.operators import reports as X
from runlens.operators.enrich import flatten_origin
from runlens.operators.errors import error_messages
from runlens.operators.sequence import number_within
from runlens.operators.sliding import sliding_percentiles
from runlens.plans import oracle as O
from runlens.plans.pipeline import Pipeline
from runlens.plans.refresh import apply_events, build_results, current_results, publish_tables, refresh
from runlens.session import new_scratch
from runlens.sources.fixture import FIXTURE_SCHEMA_PREFIX, fixture_logs, register_fixture_tables
from runlens.sources.inventory import discover, inventory_by_catalog, inventory_with_counts, log_row_counts
from runlens.sources.logs import LogSource, consolidate, read_log
from runlens.sources.sinks import ensure_schema, register_views
from runlens.streaming.monitor import StreamLog, monitored_runs, start_run_monitor

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        _REGISTRY[name] = fn
        if sql is not None:
            _ORACLE[name] = sql
        return fn

    return deco


def report(df: DataFrame, sets: tuple[str, ...] = ()) -> DataFrame:
    """Round doubles to 6 places; join array columns (``sets`` sorted
    first).  One projection over the library table."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            c = F.array_join(F.array_sort(c) if f.name in sets else c, "|")
        elif isinstance(f.dataType, T.DoubleType):
            c = F.round(c, 6)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def fixture(spark: SparkSession, sf_dir: str, cfg: Config | None = None) -> Pipeline:
    return Pipeline.from_fixture(spark, sf_dir, cfg)


# ---------------------------------------------------------------- core tables


@register("pipeline_runs", O.PIPELINE_RUNS)
def q_pipeline_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(fixture(spark, sf_dir).run_report, sets=("error_messages",))


@register("performance_metrics", O.PERFORMANCE_METRICS)
def q_performance_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(M.performance_metrics(fixture(spark, sf_dir).runs))


@register("error_analysis", O.ERROR_ANALYSIS)
def q_error_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fixture(spark, sf_dir)
    return report(M.error_analysis(p.enriched, p.cfg))


@register("recent_activity", O.RECENT_ACTIVITY)
def q_recent_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fixture(spark, sf_dir)
    return report(M.recent_activity(p.runs, p.cfg))


@register("duration_trends", O.DURATION_TRENDS)
def q_duration_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fixture(spark, sf_dir)
    return report(M.duration_trends(p.runs, p.cfg))


@register("cluster_usage", O.CLUSTER_USAGE)
def q_cluster_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(M.cluster_usage(fixture(spark, sf_dir).runs))


# ------------------------------------------------------------ sources & sinks


def _flat(df: DataFrame) -> DataFrame:
    return flatten_origin(df).drop("origin")


@register("consolidated_events", O.CONSOLIDATED_EVENTS)
def q_consolidated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union of three logs of unequal schema: per-log rows and null fills."""
    c = fixture(spark, sf_dir).consolidated
    return report(
        c.groupBy(*S.SOURCE_COLUMNS).agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(F.col("origin.batch_id").isNull()).alias("null_batch_id"),
            F.count_if(F.col("details").isNull()).alias("null_details"),
            F.count_if(F.col("origin.pipeline_id").isNull()).alias("null_pipeline_id"),
            F.min("timestamp").alias("first_event"),
            F.max("timestamp").alias("last_event"),
            F.min(S.LOAD_STAMP).alias(S.LOAD_STAMP),
        )
    )


@register("enriched_events", O.ENRICHED_EVENTS)
def q_enriched_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(fixture(spark, sf_dir).enriched.drop("origin"))


@register("recent_events", O.RECENT_EVENTS)
def q_recent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cutoff ``timestamp >= as_of - 7 days`` applied per log at the scan."""
    return report(fixture(spark, sf_dir, O.RECENT_EVENTS_CFG).enriched.drop("origin"))


@register("scan_log", O.SCAN_LOG)
def q_scan_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read one event-log table by name from the catalog."""
    catalog, schema, table = register_fixture_tables(spark, sf_dir)[2]
    return report(_flat(read_log(spark, catalog, schema, table).df))


@register("log_inventory", O.LOG_INVENTORY)
def q_log_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discovery over the session catalog with row counts: the three logs;
    the temp view and the non-matching table are skipped."""
    register_fixture_tables(spark, sf_dir)
    cfg = fixture_config(target_catalogs=("spark_catalog",), schema_filter=re.escape(FIXTURE_SCHEMA_PREFIX))
    return inventory_with_counts(spark, discover(spark, cfg)).orderBy("catalog", "schema", "table")


@register("log_row_counts", O.LOG_ROW_COUNTS)
def q_log_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_row_counts(fixture_logs(spark, sf_dir))


@register("inventory_by_catalog", O.INVENTORY_BY_CATALOG)
def q_inventory_by_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory_by_catalog(log_row_counts(fixture_logs(spark, sf_dir)))


@register("publish_roundtrip", O.PERFORMANCE_METRICS)
def q_publish_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish all tables, read performance metrics back by name."""
    names = refresh(spark, fixture_logs(spark, sf_dir), _store(spark, "roundtrip"), fixture_config(), views=False)
    return report(spark.table(names["performance_metrics"]))


@register("sql_over_views", O.SQL_OVER_VIEWS)
def q_sql_over_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = fixture_config()
    register_views(build_results(spark, fixture_logs(spark, sf_dir), cfg, materialize_states=False), cfg.table_prefix)
    return report(
        spark.sql(
            f"SELECT pipeline_name, total_runs, success_rate, avg_duration_minutes "
            f"FROM {cfg.table_prefix}performance_metrics ORDER BY avg_duration_minutes DESC"
        )
    )


# ------------------------------------------------------ filters & breakdowns


@register("failed_runs", O.FAILED_RUNS)
def q_failed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(R.failed_runs(fixture(spark, sf_dir).runs))


@register("failed_runs_7d", O.FAILED_RUNS_7D)
def q_failed_runs_7d(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fixture(spark, sf_dir)
    return report(R.failed_runs(p.runs, since=p.cfg.as_of - dt.timedelta(days=7)))


@register("pipeline_health", O.PIPELINE_HEALTH)
def q_pipeline_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(R.pipeline_health(M.performance_metrics(fixture(spark, sf_dir).runs)))


@register("runs_by_name", O.RUNS_BY_NAME)
def q_runs_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(R.runs_by_name(fixture(spark, sf_dir).run_report, O.RUNS_BY_NAME_VALUE), sets=("error_messages",))


@register("status_breakdown", O.STATUS_BREAKDOWN)
def q_status_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(X.status_breakdown(fixture(spark, sf_dir).runs))


@register("stage_counts", O.STAGE_COUNTS)
def q_stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fixture(spark, sf_dir)
    return X.stage_counts(p.consolidated, p.cfg)


# ------------------------------------------------------ documented analyses


@register("daily_success_rate", O.DAILY_SUCCESS_RATE)
def q_daily_success_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(X.daily_success_rate(fixture(spark, sf_dir).runs))


@register("performance_percentiles", O.PERFORMANCE_PERCENTILES)
def q_performance_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(X.performance_percentiles(fixture(spark, sf_dir).runs))


@register("daily_duration_trends", O.DAILY_DURATION_TRENDS)
def q_daily_duration_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(X.daily_duration_trends(fixture(spark, sf_dir).runs))


@register("recent_activity_30d", O.RECENT_ACTIVITY_30D)
def q_recent_activity_30d(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fixture(spark, sf_dir)
    return report(M.recent_activity(p.runs, p.cfg, days=30))


@register("clusters_per_pipeline", O.CLUSTERS_PER_PIPELINE)
def q_clusters_per_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(X.clusters_per_pipeline(fixture(spark, sf_dir).runs))


@register("error_signatures", O.ERROR_SIGNATURES)
def q_error_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(X.error_signatures(fixture(spark, sf_dir).enriched))


@register("run_flow_breakdown", O.RUN_FLOW_BREAKDOWN)
def q_run_flow_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(X.run_flow_breakdown(fixture(spark, sf_dir).enriched))


@register("run_time_split", O.RUN_TIME_SPLIT)
def q_run_time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(X.run_time_split(fixture(spark, sf_dir).enriched))


@register("duration_slope", O.DURATION_SLOPE)
def q_duration_slope(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fixture(spark, sf_dir)
    d = X.duration_slope(p.runs, p.cfg)
    fits = ("slope_minutes_per_day", "fitted_minutes_at_as_of", "projected_minutes")
    return report(d.select(*[F.round(c, 4).alias(c) if c in fits else F.col(c) for c in d.columns]))


@register("failed_run_detail", O.FAILED_RUN_DETAIL)
def q_failed_run_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fixture(spark, sf_dir)
    return report(X.failed_run_detail(p.runs, p.facts), sets=("error_messages", "error_datasets"))


@register("cluster_reliability_rank", O.CLUSTER_RELIABILITY_RANK)
def q_cluster_reliability_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(R.cluster_reliability_rank(fixture(spark, sf_dir).runs))


@register("duration_outliers", O.DURATION_OUTLIERS)
def q_duration_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fixture(spark, sf_dir)
    return report(X.duration_outliers(p.runs, p.cfg))


@register("alert_candidates", O.ALERT_CANDIDATES)
def q_alert_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fixture(spark, sf_dir)
    return report(R.alert_candidates(p.runs, p.cfg))


# ------------------------------------------------------------------ top-k


@register("latest_events", O.LATEST_EVENTS)
def q_latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(R.latest_events(fixture(spark, sf_dir).consolidated))


@register("latest_runs", O.LATEST_RUNS)
def q_latest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(R.latest_runs(fixture(spark, sf_dir).runs))


@register("latest_run_status", O.LATEST_RUN_STATUS)
def q_latest_run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(R.latest_run_status(fixture(spark, sf_dir).runs))


@register("busiest_pipelines", O.BUSIEST_PIPELINES)
def q_busiest_pipelines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(R.busiest_pipelines(M.performance_metrics(fixture(spark, sf_dir).runs)))


@register("slowest_pipelines", O.SLOWEST_PIPELINES)
def q_slowest_pipelines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(R.slowest_pipelines(M.performance_metrics(fixture(spark, sf_dir).runs)))


@register("most_failing", O.MOST_FAILING)
def q_most_failing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(R.most_failing(M.performance_metrics(fixture(spark, sf_dir).runs)))


@register("pipeline_rates", O.PIPELINE_RATES)
def q_pipeline_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(R.pipeline_rates(M.performance_metrics(fixture(spark, sf_dir).runs)))


@register("top_errors", O.TOP_ERRORS)
def q_top_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fixture(spark, sf_dir)
    return report(R.top_errors(M.error_analysis(p.enriched, p.cfg)))


@register("common_errors", O.COMMON_ERRORS)
def q_common_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fixture(spark, sf_dir)
    return report(R.common_errors(M.error_analysis(p.enriched, p.cfg)))


@register("latest_errors", O.LATEST_ERRORS)
def q_latest_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(R.latest_errors(_flat(fixture(spark, sf_dir).consolidated)))


# ------------------------------------------------------ incremental & streaming


def _split(logs: list[LogSource], at: dt.datetime) -> tuple[list[LogSource], list[LogSource]]:
    """The logs before and from a time on (null times come later)."""
    early, late = [], []
    for log in logs:
        before = F.col("timestamp") < time_literal(at, log.df.schema["timestamp"].dataType)
        early.append(replace(log, df=log.df.filter(before)))
        late.append(replace(log, df=log.df.filter(~before | F.col("timestamp").isNull())))
    return early, late


def _store(spark: SparkSession, name: str) -> str:
    """A fresh database under the shared folder."""
    root = new_scratch(spark, name)
    database = f"runlens_{name}_" + root.rsplit("-", 1)[-1]
    ensure_schema(spark, database, f"{root}/tables")
    return database


@register("incremental_runs", O.PIPELINE_RUNS)
def q_incremental_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events before as_of - 10 days are stored first; the rest arrives as a
    second batch (runs straddling the split receive late events).  Must equal
    the full rebuild."""
    cfg = fixture_config()
    database = _store(spark, "incremental")
    for i, part in enumerate(_split(fixture_logs(spark, sf_dir), cfg.time - dt.timedelta(days=10))):
        apply_events(spark, consolidate(part, cfg), database, cfg, "query", i)
    return report(current_results(spark, database, cfg)["pipeline_runs"], sets=("error_messages",))


@register("incremental_sliding", O.INCREMENTAL_SLIDING)
def q_incremental_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 10-day window that moves: events up to 20 January are stored and
    published with the window that ends there, then the rest arrives and the
    window ends on the 31st.  Runs that straddle the new cutoff lose their
    early events, older runs go."""
    cfg = O.SLIDING_CFG
    before = replace(cfg, as_of=dt.datetime(2024, 1, 20))
    database = _store(spark, "sliding")
    early, late = _split(fixture_logs(spark, sf_dir), before.time)
    apply_events(spark, consolidate(early, before), database, before, "query", 0)
    publish_tables(spark, database, before)
    apply_events(spark, consolidate(late, cfg), database, cfg, "query", 1)
    names = publish_tables(spark, database, cfg)
    return report(spark.table(names["pipeline_runs"]), sets=("error_messages",))


def _daily_files(spark: SparkSession, sf_dir: str, root: str) -> list[StreamLog]:
    """The fixture logs, written as daily files."""
    logs = []
    for log in fixture_logs(spark, sf_dir):
        path = f"{root}/input/{log.schema}/{log.table}"
        log.df.withColumn("event_day", F.to_date("timestamp")).write.partitionBy("event_day").parquet(path)
        schema = spark.read.parquet(path).schema
        logs.append(StreamLog(log.catalog, log.schema, log.table, path, T.StructType([f for f in schema.fields if f.name != "event_day"])))
    return logs


def _streamed(spark: SparkSession, sf_dir: str, publish_every: int = 1) -> str:
    """Database after a stream over the fixture logs, written as daily files."""
    root = new_scratch(spark, "stream")
    logs = _daily_files(spark, sf_dir, root)
    database = "runlens_stream_" + root.rsplit("-", 1)[-1]
    cfg = fixture_config()
    query = start_run_monitor(spark, logs, database, f"{root}/checkpoint", cfg, location=f"{root}/tables", max_files_per_trigger=15, publish_every=publish_every)
    query.awaitTermination()
    return database


@register("streaming_runs", O.PIPELINE_RUNS)
def q_streaming_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs that the monitor keeps must equal the batch fold."""
    return report(monitored_runs(spark, _streamed(spark, sf_dir, publish_every=1000), fixture_config()), sets=("error_messages",))


@register("streaming_events", O.STREAMING_EVENTS)
def q_streaming_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the published events table after several micro-batches."""
    database = _streamed(spark, sf_dir)
    return report(_flat(spark.table(f"{database}.evlog_consolidated_events")).drop("event_day"))


@register("streaming_after_rebuild", O.STREAMING_EVENTS)
def q_streaming_after_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rebuild over three logs, rebuild over two of them, monitor over all
    three: the files of the third count as unread, those of the two as read."""
    root = new_scratch(spark, "rebuild")
    database, cfg = _store(spark, "rebuild"), fixture_config()
    streams = _daily_files(spark, sf_dir, root)
    logs = [LogSource(s.catalog, s.schema, s.table, spark.read.parquet(s.path).drop("event_day")) for s in streams]
    refresh(spark, logs, database, cfg, views=False)
    names = refresh(spark, logs[:2], database, cfg, views=False)
    start_run_monitor(spark, streams, database, f"{root}/checkpoint", cfg, max_files_per_trigger=30).awaitTermination()
    return report(_flat(spark.table(names["consolidated_events"])).drop("event_day"))


@register("sliding_percentiles", O.SLIDING_PERCENTILES)
def q_sliding_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of 7-day windows from the published daily states alone."""
    cfg, database = fixture_config(), _store(spark, "percentiles")
    refresh(spark, fixture_logs(spark, sf_dir), database, cfg, views=False)
    sketches, histogram = (spark.table(f"{database}.evlog_{key}") for key in ("daily_sketches", "daily_durations"))
    return report(sliding_percentiles(sketches, histogram, cfg))


# ------------------------------------------------------ whole results, in order


@register("error_messages", O.ERROR_MESSAGES)
def q_error_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message of every error group."""
    return error_messages(fixture(spark, sf_dir).errors)


def _in_order(df: DataFrame, order: tuple[tuple[str, bool], ...]) -> DataFrame:
    """``df`` with each row's place in the order, from 1, so that a check sees
    the order too."""
    placed = number_within(df.withColumn("_all", F.lit(0)), ["_all"], M.ordered(order), "position")
    return placed.withColumn("position", F.col("position") + 1).drop("_all")


@register("recent_activity_report", O.RECENT_ACTIVITY_REPORT)
def q_recent_activity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fixture(spark, sf_dir)
    return _in_order(report(M.recent_activity(p.runs, p.cfg)), M.RECENT_ORDER)


@register("duration_trends_report", O.DURATION_TRENDS_REPORT)
def q_duration_trends_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fixture(spark, sf_dir)
    return _in_order(report(M.duration_trends(p.runs, p.cfg)), M.TREND_ORDER)


@register("cluster_usage_report", O.CLUSTER_USAGE_REPORT)
def q_cluster_usage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_order(report(M.cluster_usage(fixture(spark, sf_dir).runs)), M.CLUSTER_ORDER)


@register("consolidated_mixed", O.CONSOLIDATED_MIXED)
def q_consolidated_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs whose columns differ in case and width: ``id`` int in one and
    ``ID`` bigint in another, ``weight`` float in one, double in the next and
    absent in the last."""
    logs = fixture_logs(spark, sf_dir)
    weight = F.col("id") % 8 / F.lit(2)
    narrow = replace(logs[0], df=logs[0].df.withColumn("weight", weight.cast("float")).withColumn("id", F.col("id").cast("int")))
    upper = replace(logs[1], df=logs[1].df.withColumn("Weight", weight.cast("double")).withColumnRenamed("id", "ID"))
    return report(_flat(consolidate([narrow, upper, logs[2]], fixture_config())))


@register("published_tables", O.PUBLISHED_TABLES)
def q_published_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each published table, read back by name."""
    names = refresh(spark, fixture_logs(spark, sf_dir), _store(spark, "published"), fixture_config(), views=False)
    counts = [spark.table(name).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(key).alias("table_name"), "row_count") for key, name in names.items()]
    return reduce(DataFrame.union, counts)


@register("log_inventory_listed", O.LOG_INVENTORY)
def q_log_inventory_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discovery without given catalogs: they are listed, system ones left
    out, and filtered by a pattern."""
    register_fixture_tables(spark, sf_dir)
    cfg = fixture_config(catalog_filter="spark_cat.*", schema_filter=re.escape(FIXTURE_SCHEMA_PREFIX))
    return inventory_with_counts(spark, discover(spark, cfg)).orderBy("catalog", "schema", "table")


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)
