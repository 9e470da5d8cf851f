"""Refresh plans: every result table from one fold of the logs.

``build_results`` (lazy) reads each log once: events are staged to the shared
folder column-pruned, and every table is derived from that.

Publishing keeps an append-only store in the database (``plans.store``):

* a batch writes one segment, its events and what they add to the mergeable
  states per event date, and one row of the manifest commits it;
* segments of a level are merged into one of the next when there are enough of
  them, so that a table is derived from few files after any number of batches;
* ``publish_tables`` derives the published tables at the configuration's
  ``as_of`` from the partials in its window, and folds anew only the events of
  the day that the cutoff cuts.  All views follow one row, appended when every
  table of the version is written;
* a rebuild writes a new generation, with the files it has read; a monitor
  skips these.  A failure on the way leaves everything as it was.

A generation holds the events from its rebuild's cutoff on; a window that
begins earlier needs a rebuild.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens import schema as S

from runlens.config import Config
from runlens.functions.exprs import date_literal, time_literal
from runlens.operators import metrics as M
from runlens.operators.enrich import enrich
from runlens.operators.errors import error_messages, error_state, finalize_error_state, merge_error_state
from runlens.operators.runs import FLOW, MESSAGE, finalize_runs, merge_run_facts, merge_run_state, run_facts, run_state, with_error_detail, with_fact_counts
from runlens.operators.sliding import daily_durations, daily_sketches
from runlens.plans.store import BASE, BATCH, COVERED_KEY, DATE_COLUMN, ERRORS, EVENTS, FACTS, FILE_COLUMN, MERGE, RUNS, Manifest, Store
from runlens.session import materialize, new_scratch
from runlens.sources.logs import LogSource, aligned_columns, consolidate, quote
from runlens.sources.sinks import ensure_schema, register_views, write_table

#: Published tables as they are stored; runs are put together by their view.
RUN_ROWS, RUN_FACTS = "run_rows", "run_facts"
VERSION_COLUMN = "version"


def derive_tables(state: DataFrame, facts: DataFrame, errors: DataFrame, cfg: Config) -> dict[str, DataFrame]:
    """The analysis tables from the three states."""
    runs = finalize_runs(state, cfg)
    return {"pipeline_runs": with_error_detail(runs, facts), **_summaries(runs, errors, cfg)}


def _summaries(runs: DataFrame, errors: DataFrame, cfg: Config) -> dict[str, DataFrame]:
    return {
        "performance_metrics": M.performance_metrics(runs),
        "error_analysis": finalize_error_state(errors),
        "error_messages": error_messages(errors),
        "recent_activity": M.recent_activity(runs, cfg),
        "duration_trends": M.duration_trends(runs, cfg),
        "cluster_usage": M.cluster_usage(runs),
    }


def build_results(spark: SparkSession, logs: list[LogSource], cfg: Config, materialize_states: bool = True) -> dict[str, DataFrame]:
    """All tables without publishing.  With ``materialize_states`` the logs
    are read once, into a staged copy with the columns that the states need,
    and the run and error states are checkpointed."""
    consolidated = consolidate(logs, cfg)
    enriched = enrich(consolidated)
    if materialize_states:
        path = new_scratch(spark, "staged")
        needed = ["timestamp", "event_type", "level", "message", "source_full_name", "pipeline_id", "pipeline_name", "pipeline_type", "update_id", "flow_name", "cluster_id"]
        enriched.select(*needed).write.parquet(path)
        enriched = spark.read.parquet(path)
    state, facts, errors = run_state(enriched, cfg), run_facts(enriched, cfg), error_state(enriched)
    if materialize_states:
        state, errors = materialize(state), materialize(errors)
    return {"consolidated_events": consolidated, **derive_tables(state, facts, errors, cfg)}


# ------------------------------------------------------------------- the store


def _together(jobs: list[Callable[[], object]]) -> list:
    """Independent writes at once: their jobs share the executors."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


def _write_segment(store: Store, segment: str, tables: dict[str, DataFrame]) -> None:
    _together([lambda key=key, df=df: write_table(df, store.name(key, segment), store.cfg.output_format, [DATE_COLUMN] if key == EVENTS else None) for key, df in tables.items()])


def apply_events(spark: SparkSession, events: DataFrame, database: str, cfg: Config, source: str = "manual", batch_id: int = 0, generation: int | None = None) -> int:
    """Add one batch of consolidated events to the store, exactly once per
    (source, batch_id), and return its generation; ``generation``: begin this
    one with them.

    1. The events are written as the table of a new segment.
    2. They are read back from there, and folded into partials per event date.
    3. One row in the manifest commits the segment.

    It opens no older events or partials.  A retry starts over with another
    segment; those of attempts without a commit are never seen."""
    store = Store(spark, database, cfg)
    now = store.manifest(source, batch_id)
    rebuild = generation is not None
    if not rebuild:
        if now.done:
            return now.generation
        generation = max(now.generation, 1)
        if now.from_time is not None:
            events = events.filter(F.col("timestamp") >= time_literal(now.from_time, events.schema["timestamp"].dataType))
        if now.segments:  # types that clash are an error before anything is written
            store.event_schema(now.segments, events)
    segment = store.new_segment(generation, base=rebuild)
    staged = events.withColumn(DATE_COLUMN, F.to_date("timestamp"))
    if cfg.consolidated_files:
        # range bounds come from a sample, so a busy day spreads over tasks
        staged = staged.repartitionByRange(cfg.consolidated_files, DATE_COLUMN, "timestamp")
    _write_segment(store, segment, {EVENTS: staged})
    own = spark.table(store.name(EVENTS, segment))
    batch, by = enrich(own), [DATE_COLUMN]
    tables = {RUNS: run_state(batch, cfg, by), FACTS: run_facts(batch, cfg, by), ERRORS: error_state(batch, by)}
    if rebuild and FILE_COLUMN in own.columns:
        tables[COVERED_KEY] = own.filter(F.col(FILE_COLUMN).isNotNull()).select("source_full_name", F.col(FILE_COLUMN).alias("file")).distinct()
    _write_segment(store, segment, tables)
    store.commit(now, BATCH, generation, segment, BASE if rebuild else 0, source, int(batch_id), from_time=cfg.cutoff if rebuild else None)
    merge_segments(spark, database, cfg)
    return generation


def merge_segments(spark: SparkSession, database: str, cfg: Config) -> int:
    """Merge the segments of each level that has ``cfg.merge_fanout`` of them
    into one of the next level; returns how many merges there were.

    The merged segment and what it replaces change places by one row of the
    manifest.  Replaced tables stay until no version that readers may hold
    shows them.  The segment of a rebuild is left alone.  An event is written
    once for each level, so n batches cost n log n writes and leave log n
    segments."""
    store, merges = Store(spark, database, cfg), 0
    while cfg.merge_fanout:
        now = store.manifest()
        full = [n for n in sorted(set(now.segments.values())) if n < BASE and len(now.at_level(n)) >= max(2, cfg.merge_fanout)]
        if not full:
            break
        old, segment, by = now.at_level(full[0]), store.new_segment(now.generation), [DATE_COLUMN]
        merged = {
            EVENTS: store.events(old).hint("rebalance", DATE_COLUMN),
            RUNS: merge_run_state(store.partials(RUNS, old), by=by),
            FACTS: merge_run_facts(store.partials(FACTS, old), by=by),
            ERRORS: merge_error_state(store.partials(ERRORS, old), by=by),
        }
        _write_segment(store, segment, merged)
        store.commit(now, MERGE, now.generation, segment, full[0] + 1, replaces=old)
        merges += 1
    return merges


def _window(rows: DataFrame, cutoff: dt.datetime | None, whole_days: bool) -> DataFrame:
    """Partials of the days in the window; the day that the cutoff cuts is in
    it only if it is whole."""
    if cutoff is None:
        return rows
    day = date_literal(cutoff.date())
    return rows.filter(F.col(DATE_COLUMN) >= day if whole_days else F.col(DATE_COLUMN) > day)


def current_states(spark: SparkSession, database: str, cfg: Config, manifest: Manifest | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Run state, run facts and error state of the events at or after the
    cutoff.  A merged minimum can't be taken apart again, so partials are kept
    per day; events of a day that the cutoff cuts are folded anew."""
    store = Store(spark, database, cfg)
    live = (manifest or store.manifest()).segments
    cutoff = cfg.cutoff
    whole = cutoff is None or cutoff.time() == dt.time()
    parts = {key: [_window(store.partials(key, live), cutoff, whole).drop(DATE_COLUMN)] for key in (RUNS, FACTS, ERRORS)}
    if not whole:
        events = store.events(live).filter(F.col(DATE_COLUMN) == date_literal(cutoff.date()))
        rest = enrich(events.filter(F.col("timestamp") >= time_literal(cutoff, events.schema["timestamp"].dataType)))
        parts[RUNS].append(run_state(rest, cfg))
        parts[FACTS].append(run_facts(rest, cfg))
        parts[ERRORS].append(error_state(rest))
    return merge_run_state(*parts[RUNS]), merge_run_facts(*parts[FACTS]), merge_error_state(*parts[ERRORS])


def current_results(spark: SparkSession, database: str, cfg: Config) -> dict[str, DataFrame]:
    """The tables of the store at ``cfg.as_of``, not published."""
    return derive_tables(*current_states(spark, database, cfg), cfg)


# ------------------------------------------------------------------ publishing


def _events_view(store: Store, segments: list[str]) -> str:
    """SQL of the events that the shown version holds, out of these segments."""
    target = store.event_schema(segments)
    kind = target["timestamp"].dataType.simpleString()
    cutoff = store.shown("cutoff", segments)
    # a plan that is older than all versions that are kept is an error, not empty
    shown = f"coalesce({store.shown('segments', segments)}, CAST(raise_error('this version of the events is gone, read the view anew') AS array<string>))"
    parts = []
    for s in segments:
        table = store.name(EVENTS, s)
        columns = aligned_columns(store.spark.table(table).schema, target)
        parts.append(
            f"SELECT {', '.join(columns)}, {DATE_COLUMN} FROM {table} WHERE array_contains({shown}, '{s}')"
            f" AND ({cutoff} IS NULL OR {DATE_COLUMN} >= CAST({cutoff} AS DATE)) AND ({cutoff} IS NULL OR timestamp >= CAST({cutoff} AS {kind}))"
        )
    return " UNION ALL ".join(parts)


def _runs_view(store: Store, columns: list[str]) -> str:
    """SQL of the runs with their lists, which are made when they are read."""
    keys = ", ".join(S.RUN_KEYS)
    same = " AND ".join(f"r.{k} <=> f.{k}" for k in S.RUN_KEYS)
    lists = f"SELECT {keys}, array_sort(collect_list(value)) AS messages FROM {store.name(RUN_FACTS)} WHERE kind = '{MESSAGE}' GROUP BY {keys}"
    out = []
    for c in columns:
        out.append(f"r.{c}")
        if c == "info_count":
            out.append("coalesce(f.messages, CAST(array() AS array<string>)) AS error_messages")
    return f"SELECT {', '.join(out)} FROM {store.name(RUN_ROWS)} r LEFT JOIN ({lists}) f ON {same}"


def _stored(key: str) -> str:
    return f"published_{key}"


def _put(store: Store, key: str, df: DataFrame, version: int) -> bool:
    """Write a table of a version; what a failed attempt at the same version
    has left is overwritten.  Columns of other types replace the table; returns
    whether the table is new."""
    name = store.name(_stored(key))
    if store.exists(name):
        have = store.spark.table(name).drop(VERSION_COLUMN).schema
        if [(f.name, f.dataType.simpleString()) for f in have.fields] == [(f.name, f.dataType.simpleString()) for f in df.schema.fields]:
            view = f"{key}_{uuid.uuid4().hex}"
            df.createTempView(view)
            store.spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({VERSION_COLUMN} = {version}) SELECT * FROM {view}")
            store.spark.catalog.dropTempView(view)
            return False
    write_table(df.withColumn(VERSION_COLUMN, F.lit(version)), name, store.cfg.output_format, [VERSION_COLUMN])
    return True


def publish_tables(spark: SparkSession, database: str, cfg: Config, views: bool = False) -> dict[str, str]:
    """Derive and publish all tables at ``cfg.as_of``; returns key -> name.

    Every table of the new version is written first, where the views don't
    look; one row then switches all views.  The version before stays for
    readers that have begun, older ones and segments that neither shows go.

    Runs are stored as rows of bounded size and as long-form facts, in
    ``run_rows`` and ``run_facts``; ``pipeline_runs`` joins them when it is
    read.  ``daily_sketches`` and ``daily_durations`` hold the durations of each
    pipeline and day, for percentiles of any window (``operators.sliding``)."""
    store = Store(spark, database, cfg)
    now, before = store.manifest(), store.versions()
    version = before[0].version + 1 if before else 1
    state, facts, errors = current_states(spark, database, cfg, now)
    state, errors = materialize(state), materialize(errors)
    new = {RUN_FACTS} if _put(store, RUN_FACTS, facts, version) else set()
    facts = spark.table(store.name(_stored(RUN_FACTS))).filter(F.col(VERSION_COLUMN) == version).drop(VERSION_COLUMN)
    runs = finalize_runs(state, cfg)
    summaries = _summaries(runs, errors, cfg)
    daily = {"daily_sketches": daily_sketches(runs), "daily_durations": daily_durations(runs)}
    tables = {RUN_ROWS: with_fact_counts(runs, facts), **summaries, **daily}
    made = _together([lambda key=key, df=df: _put(store, key, df, version) for key, df in tables.items()])
    new |= {key for key, is_new in zip(tables, made, strict=True) if is_new}

    events, live = store.name("consolidated_events"), list(now.segments)
    old = list(before[0].segments) if before else []
    if before and set(old) != set(live):
        try:  # both versions' segments, each shown by its version
            spark.sql(f"CREATE OR REPLACE VIEW {events} AS {_events_view(store, list(dict.fromkeys([*old, *live])))}")
        except S.SchemaClashError:
            pass  # a rebuild has changed a type: the view follows after the switch
    store.switch(version, now)
    if set(old) != set(live) or not store.exists(events):
        spark.sql(f"CREATE OR REPLACE VIEW {events} AS {_events_view(store, live)}")
    for key, df in {RUN_FACTS: facts, **tables}.items():
        if key in new or not store.exists(store.name(key)):
            spark.sql(f"CREATE OR REPLACE VIEW {store.name(key)} AS SELECT {', '.join(map(quote, df.columns))} FROM {store.name(_stored(key))} WHERE {VERSION_COLUMN} = {store.shown(VERSION_COLUMN)}")
    if new & {RUN_FACTS, RUN_ROWS} or not store.exists(store.name("pipeline_runs")):
        spark.sql(f"CREATE OR REPLACE VIEW {store.name('pipeline_runs')} AS {_runs_view(store, runs.columns)}")

    store.drop_versions([_stored(k) for k in (RUN_FACTS, *tables)], version - 1)
    kept = {*live, *(old if before and before[0].generation == now.generation else [])}
    store.drop_segments(store.segments_of(now.generation) - kept)
    for table, m in store.tables(r"\w+_g(\d+)"):
        if int(m.group(1)) < now.generation:
            store.drop(table)
    names = {key: store.name(key) for key in ("consolidated_events", "pipeline_runs", *summaries)}
    if views:
        register_views({k: spark.table(v) for k, v in names.items()}, cfg.table_prefix)
    return names


def uncovered(batch: DataFrame, database: str, cfg: Config, path_column: str) -> DataFrame:
    """Events of a batch whose file this generation's rebuild has not read,
    without the path."""
    store = Store(batch.sparkSession, database, cfg)
    name = store.name(COVERED_KEY, f"g{store.manifest().generation}")
    if store.exists(name):
        seen = store.spark.table(name).select(F.col("file").alias(path_column)).distinct()
        batch = batch.withColumn(path_column, _plain(F.col(path_column))).join(seen, path_column, "left_anti")
    return batch.drop(path_column)


def _plain(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "/")


def _with_file(log: LogSource) -> LogSource:
    """The log with each event's file, where its rows come from files."""
    try:
        return replace(log, df=log.df.select("*", _plain(F.col("_metadata.file_path")).alias(FILE_COLUMN)))
    except AnalysisException:
        return log


def refresh(spark: SparkSession, logs: list[LogSource], database: str, cfg: Config, location: str | None = None, views: bool = True) -> dict[str, str]:
    """Full rebuild; returns key -> published name.  Each source log is
    scanned once, into a new generation; the published tables and the old
    generation stay until the new one is published.  The names of the files
    that were read come along as a column and are committed with the events."""
    ensure_schema(spark, database, location)
    store = Store(spark, database, cfg)
    generation = max(store.manifest().generation, store.last_generation()) + 1
    events = consolidate([_with_file(log) for log in logs], cfg)
    apply_events(spark, events, database, cfg, source="full", batch_id=generation, generation=generation)
    return publish_tables(spark, database, cfg, views)


def incremental_refresh(
    spark: SparkSession,
    new_logs: list[LogSource],
    database: str,
    cfg: Config,
    *,
    batch_id: int,
    source: str = "manual",
    views: bool = True,
) -> dict[str, str]:
    """Add ``new_logs`` (events not seen before) and publish, exactly once per
    (source, batch_id): calling it again with the same batch id after a
    failure or a success changes nothing twice.  On an empty database the
    first batch builds every table."""
    ensure_schema(spark, database)
    apply_events(spark, consolidate(new_logs, cfg), database, cfg, source, batch_id)
    return publish_tables(spark, database, cfg, views)
