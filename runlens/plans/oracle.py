"""DuckDB SQL for every registered query (the independent oracle).

Each string re-derives the fixture event logs from the ``events`` view
(FIXTURES.md §2) and computes the same table with plain SQL, so a match
checks the Spark plan end to end.  Conventions shared with the Spark
report forms: doubles rounded to 6 places, sets emitted as sorted
``|``-joined text, ordered lists as ``|``-joined text in list order.
"""

from __future__ import annotations

import datetime as dt

from runlens.config import Config
from runlens.sources.fixture import fixture_config

CFG = fixture_config()


def _ts(x: dt.datetime) -> str:
    return f"TIMESTAMP '{x.strftime('%Y-%m-%d %H:%M:%S')}'"


def _d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


def _base(cfg: Config = CFG) -> str:
    cutoff = f"WHERE ts >= {_ts(cfg.cutoff)}" if cfg.cutoff else ""
    return f"""
base AS (
  SELECT event_id, ts, event_type, value, props, user_id % 12 AS p, event_id // 96 AS b
  FROM events
),
logs AS (
  SELECT
    event_id AS id,
    ts AS "timestamp",
    event_type,
    CASE WHEN (event_type = 'error' AND value > 60) OR (event_type = 'purchase' AND value > 150) THEN 'ERROR'
         WHEN event_type = 'signup' AND value > 40 THEN 'WARN'
         WHEN event_type = 'view' AND value < 5 THEN 'METRICS'
         ELSE 'INFO' END AS level,
    CASE WHEN event_id % 97 = 0 THEN NULL
         ELSE event_type || ' code ' || CAST(event_id % 7 AS VARCHAR) END AS message,
    CASE WHEN event_id % 50 = 0 THEN NULL ELSE 'p' || CAST(p AS VARCHAR) END AS pipeline_id,
    'pipe_' || CAST(p % 10 AS VARCHAR) AS pipeline_name,
    CASE WHEN p % 2 = 0 THEN 'WORKSPACE' ELSE 'TABLE' END AS pipeline_type,
    CASE WHEN event_id % 41 = 0 THEN NULL
         ELSE 'u' || CAST(p AS VARCHAR) || '-' || CAST(b AS VARCHAR) END AS update_id,
    'fl' || CAST(event_id % 5 AS VARCHAR) AS flow_id,
    'flow_' || CAST(event_id % 5 AS VARCHAR) AS flow_name,
    CASE WHEN p = 11 THEN NULL ELSE 'c' || CAST(b % 3 AS VARCHAR) END AS cluster_id,
    CASE WHEN p % 3 = 1 THEN NULL ELSE CAST(event_id // 10 AS VARCHAR) END AS batch_id,
    'r' || CAST(event_id AS VARCHAR) AS request_id,
    CASE WHEN p % 3 = 2 THEN props END AS details,
    'cat' || CAST(p % 3 % 2 AS VARCHAR) AS source_catalog,
    's' || CAST(p % 3 AS VARCHAR) AS source_schema,
    'event_log_' || CAST(p % 3 AS VARCHAR) AS source_table,
    'cat' || CAST(p % 3 % 2 AS VARCHAR) || '.s' || CAST(p % 3 AS VARCHAR)
      || '.event_log_' || CAST(p % 3 AS VARCHAR) AS source_full_name
  FROM base
  {cutoff}
),
enriched AS (
  SELECT * FROM logs WHERE pipeline_id IS NOT NULL
)"""


def _secs(x: str) -> str:
    return f"CAST(floor(epoch({x})) AS BIGINT)"


def _run_groups(source: str = "enriched", name: str = "run_groups") -> str:
    return f"""
{name} AS (
  SELECT
    pipeline_id, pipeline_name, update_id, source_full_name,
    min("timestamp") AS run_start,
    max("timestamp") AS run_end,
    CAST(min("timestamp") AS DATE) AS run_date,
    count(*) AS total_events,
    count(DISTINCT event_type) AS unique_event_types,
    count(*) FILTER (WHERE level = 'ERROR') AS error_count,
    count(*) FILTER (WHERE level = 'WARN') AS warning_count,
    count(*) FILTER (WHERE level = 'INFO') AS info_count,
    coalesce(array_to_string(list_sort(list(DISTINCT message) FILTER (WHERE level = 'ERROR' AND message IS NOT NULL)), '|'), '')
      AS error_messages,
    arg_min(cluster_id, ("timestamp", cluster_id)) FILTER (WHERE cluster_id IS NOT NULL) AS cluster_id,
    arg_min(pipeline_type, ("timestamp", pipeline_type)) FILTER (WHERE pipeline_type IS NOT NULL) AS pipeline_type
  FROM {source}
  GROUP BY pipeline_id, pipeline_name, update_id, source_full_name
)"""


def _runs(cfg: Config = CFG, groups: str = "run_groups", name: str = "runs") -> str:
    return f"""
{name} AS (
  SELECT *,
    {_secs('run_end')} - {_secs('run_start')} AS dur_s,
    ({_secs('run_end')} - {_secs('run_start')}) / 60.0 AS duration_minutes,
    error_count > 0 AS has_errors,
    CASE WHEN error_count > 0 THEN 'FAILED'
         WHEN total_events < {cfg.incomplete_below_events} THEN 'INCOMPLETE'
         ELSE 'SUCCESS' END AS status
  FROM {groups}
  WHERE ({_secs('run_end')} - {_secs('run_start')}) / 60.0 > {cfg.min_run_minutes}
)"""


def with_runs(select: str, cfg: Config = CFG, extra: str = "") -> str:
    ctes = _base(cfg) + "," + _run_groups() + "," + _runs(cfg)
    if extra:
        ctes += "," + extra
    return f"WITH {ctes}\n{select}"


def with_events(select: str, cfg: Config = CFG, extra: str = "") -> str:
    ctes = _base(cfg)
    if extra:
        ctes += "," + extra
    return f"WITH {ctes}\n{select}"


def r6(x: str) -> str:
    return f"round({x}, 6)"


# exact-sum forms of the duration aggregates (same formulas as functions/exprs.py)
MEAN_MIN = "(sum(dur_s) / count(dur_s) / 60.0)"
STDDEV_MIN = (
    "(CASE WHEN count(dur_s) > 1 THEN sqrt(CAST(CAST(count(dur_s) AS HUGEINT) * sum(CAST(dur_s AS HUGEINT) * dur_s)"
    " - CAST(sum(dur_s) AS HUGEINT) * sum(dur_s) AS DOUBLE) / CAST(count(dur_s) * (count(dur_s) - 1) AS DOUBLE)) / 60.0 END)"
)


PIPELINE_RUNS = with_runs(
    """
SELECT pipeline_id, pipeline_name, update_id, source_full_name, run_start, run_end, run_date,
       total_events, unique_event_types, error_count, warning_count, info_count, error_messages,
       cluster_id, pipeline_type, round(duration_minutes, 6) AS duration_minutes, has_errors, status
FROM runs"""
)

PERF_SELECT = f"""
  SELECT pipeline_name, pipeline_id,
    count(*) AS total_runs,
    {MEAN_MIN} AS avg_duration_minutes,
    min(duration_minutes) AS min_duration_minutes,
    max(duration_minutes) AS max_duration_minutes,
    {STDDEV_MIN} AS duration_stddev,
    CAST(sum(error_count) AS BIGINT) AS total_errors,
    CAST(sum(warning_count) AS BIGINT) AS total_warnings,
    count(*) FILTER (WHERE status = 'SUCCESS') AS successful_runs,
    count(*) FILTER (WHERE status = 'FAILED') AS failed_runs,
    count(DISTINCT cluster_id) AS unique_clusters,
    max(run_date) AS last_run_date,
    avg(total_events) AS avg_events_per_run,
    count(*) FILTER (WHERE status = 'SUCCESS') / CAST(count(*) AS DOUBLE) AS success_rate,
    count(*) FILTER (WHERE status = 'FAILED') / CAST(count(*) AS DOUBLE) AS failure_rate,
    {MEAN_MIN} / 60 AS avg_duration_hours
  FROM runs
  GROUP BY pipeline_name, pipeline_id"""

PERF_CTE = f"perf AS ({PERF_SELECT}\n)"

PERF_COLUMNS = (
    "pipeline_name, pipeline_id, total_runs, round(avg_duration_minutes, 6) AS avg_duration_minutes, "
    "round(min_duration_minutes, 6) AS min_duration_minutes, round(max_duration_minutes, 6) AS max_duration_minutes, "
    "round(duration_stddev, 6) AS duration_stddev, total_errors, total_warnings, successful_runs, failed_runs, "
    "unique_clusters, last_run_date, round(avg_events_per_run, 6) AS avg_events_per_run, "
    "round(success_rate, 6) AS success_rate, round(failure_rate, 6) AS failure_rate, "
    "round(avg_duration_hours, 6) AS avg_duration_hours"
)

PERFORMANCE_METRICS = with_runs(f"SELECT {PERF_COLUMNS} FROM perf", extra=PERF_CTE)


def _errs_cte(cfg: Config = CFG) -> str:
    return """errs AS (
  SELECT pipeline_name, pipeline_id, event_type,
    count(*) AS error_count,
    count(DISTINCT update_id) AS affected_runs,
    min("timestamp") AS first_error,
    max("timestamp") AS last_error,
    (list(message ORDER BY "timestamp" ASC NULLS LAST, message) FILTER (WHERE message IS NOT NULL))[1] AS sample_message
  FROM enriched
  WHERE level = 'ERROR'
  GROUP BY pipeline_name, pipeline_id, event_type
)"""


def _error_analysis(cfg: Config = CFG) -> str:
    return with_events("SELECT * FROM errs", cfg, extra=_errs_cte(cfg))


ERROR_ANALYSIS = _error_analysis()


def _recent_activity(cfg: Config = CFG, days: int | None = None) -> str:
    days = cfg.recent_days if days is None else days
    since = cfg.as_of_date - dt.timedelta(days=days)
    return with_runs(
        f"""
SELECT run_date, pipeline_name,
  count(*) AS total_runs,
  count(*) FILTER (WHERE status = 'SUCCESS') AS successful_runs,
  count(*) FILTER (WHERE status = 'FAILED') AS failed_runs,
  round({MEAN_MIN}, 6) AS avg_duration,
  CAST(sum(total_events) AS BIGINT) AS total_events,
  round(count(*) FILTER (WHERE status = 'SUCCESS') / CAST(count(*) AS DOUBLE), 6) AS success_rate_daily
FROM runs
WHERE run_date >= {_d(since)}
GROUP BY run_date, pipeline_name"""
    )


RECENT_ACTIVITY = _recent_activity()

DURATION_TRENDS = with_runs(
    f"""
SELECT pipeline_name,
  count(*) AS runs,
  round({MEAN_MIN}, 6) AS avg_minutes,
  round(max(duration_minutes), 6) AS max_minutes,
  round(min(duration_minutes), 6) AS min_minutes,
  round(quantile_disc(duration_minutes, 0.5), 6) AS median_minutes,
  round(quantile_disc(duration_minutes, 0.95), 6) AS p95_minutes
FROM runs
WHERE duration_minutes > {CFG.trend_min_minutes}
GROUP BY pipeline_name"""
)

CLUSTER_CTE = f"""cluster AS (
  SELECT pipeline_name, cluster_id,
    count(*) AS runs_on_cluster,
    {MEAN_MIN} AS avg_duration_on_cluster,
    count(*) FILTER (WHERE status = 'SUCCESS') AS successful_runs,
    count(*) FILTER (WHERE status = 'SUCCESS') / CAST(count(*) AS DOUBLE) AS success_rate_cluster
  FROM runs
  GROUP BY pipeline_name, cluster_id
)"""

CLUSTER_USAGE = with_runs(
    """
SELECT pipeline_name, cluster_id, runs_on_cluster, round(avg_duration_on_cluster, 6) AS avg_duration_on_cluster,
       successful_runs, round(success_rate_cluster, 6) AS success_rate_cluster
FROM cluster""",
    extra=CLUSTER_CTE,
)


# ------------------------------------------------------------ sources

_RAW = fixture_config(days_back=None)

FLAT_COLUMNS = (
    'id, "timestamp", level, event_type, message, details, pipeline_id, pipeline_name, pipeline_type, '
    "update_id, flow_id, flow_name, cluster_id, batch_id, request_id, "
    "source_catalog, source_schema, source_table, source_full_name"
)


def _stamp(cfg: Config = CFG) -> str:
    return f"{_ts(cfg.as_of)} AS consolidated_at"


CONSOLIDATED_EVENTS = with_events(
    f"""
SELECT source_catalog, source_schema, source_table, source_full_name,
  count(*) AS row_count,
  count(*) FILTER (WHERE batch_id IS NULL) AS null_batch_id,
  count(*) FILTER (WHERE details IS NULL) AS null_details,
  count(*) FILTER (WHERE pipeline_id IS NULL) AS null_pipeline_id,
  min("timestamp") AS first_event,
  max("timestamp") AS last_event,
  {_stamp()}
FROM logs
GROUP BY source_catalog, source_schema, source_table, source_full_name"""
)

ENRICHED_EVENTS = with_events(f"SELECT {FLAT_COLUMNS}, {_stamp()} FROM enriched")

RECENT_EVENTS_CFG = fixture_config(days_back=7)
RECENT_EVENTS = with_events(f"SELECT {FLAT_COLUMNS}, {_stamp()} FROM enriched", RECENT_EVENTS_CFG)

SCAN_LOG = with_events(
    """
SELECT id, "timestamp", level, event_type, message, details, pipeline_id, pipeline_name, pipeline_type,
       update_id, flow_id, flow_name, cluster_id, batch_id, request_id
FROM logs WHERE source_table = 'event_log_2'""",
    _RAW,
)

LOG_ROW_COUNTS = with_events(
    """
SELECT source_catalog AS catalog, source_schema AS schema, source_table AS "table",
       source_full_name AS full_name, count(*) AS row_count
FROM logs GROUP BY ALL""",
    _RAW,
)

LOG_INVENTORY = with_events(
    """
SELECT 'spark_catalog' AS catalog, 'runlens_fx_' || source_schema AS schema, source_table AS "table",
       'spark_catalog.runlens_fx_' || source_schema || '.' || source_table AS full_name,
       'ok' AS status, CAST(NULL AS VARCHAR) AS reason, count(*) AS row_count
FROM logs GROUP BY source_schema, source_table""",
    _RAW,
)

INVENTORY_BY_CATALOG = with_events(
    """
SELECT source_catalog AS catalog, count(DISTINCT source_full_name) AS table_count,
       CAST(count(*) AS BIGINT) AS total_rows
FROM logs GROUP BY source_catalog""",
    _RAW,
)

SQL_OVER_VIEWS = with_runs(
    """
SELECT pipeline_name, total_runs, round(success_rate, 6) AS success_rate,
       round(avg_duration_minutes, 6) AS avg_duration_minutes
FROM perf""",
    extra=PERF_CTE,
)

# ------------------------------------------------------ filters & breakdowns

FAILED_RUNS = with_runs(
    """
SELECT pipeline_name, run_start, round(duration_minutes, 6) AS duration_minutes, error_count
FROM runs WHERE status = 'FAILED'"""
)

FAILED_RUNS_7D = with_runs(
    f"""
SELECT pipeline_name, run_start, round(duration_minutes, 6) AS duration_minutes, error_count
FROM runs WHERE status = 'FAILED' AND run_start >= {_ts(CFG.as_of - dt.timedelta(days=7))}"""
)

PIPELINE_HEALTH = with_runs(
    """
SELECT pipeline_name, total_runs, round(success_rate, 6) AS success_rate,
       round(avg_duration_minutes, 6) AS avg_duration_minutes
FROM perf WHERE success_rate < 0.95 OR avg_duration_minutes > 60""",
    extra=PERF_CTE,
)

RUNS_BY_NAME_VALUE = "pipe_1"

RUNS_BY_NAME = with_runs(
    f"""
SELECT pipeline_id, pipeline_name, update_id, source_full_name, run_start, run_end, run_date,
       total_events, unique_event_types, error_count, warning_count, info_count, error_messages,
       cluster_id, pipeline_type, round(duration_minutes, 6) AS duration_minutes, has_errors, status
FROM runs WHERE pipeline_name = '{RUNS_BY_NAME_VALUE}'"""
)

STATUS_BREAKDOWN = with_runs(
    """
SELECT status, count(*) AS runs, CAST(sum(total_events) AS BIGINT) AS events,
       CAST(sum(error_count) AS BIGINT) AS errors
FROM runs GROUP BY status"""
)

STAGE_COUNTS = with_runs(
    """
SELECT 'consolidated' AS stage, count(*) AS row_count FROM logs
UNION ALL SELECT 'enriched', count(*) FROM enriched
UNION ALL SELECT 'run_groups', count(*) FROM run_groups
UNION ALL SELECT 'runs', count(*) FROM runs"""
)

# ------------------------------------------------------ documented analyses

DAILY_SUCCESS_RATE = with_runs(
    """
SELECT run_date, count(*) AS total_runs,
  count(*) FILTER (WHERE status = 'SUCCESS') AS successful_runs,
  count(*) FILTER (WHERE status = 'FAILED') AS failed_runs,
  round(count(*) FILTER (WHERE status = 'SUCCESS') / CAST(count(*) AS DOUBLE), 6) AS success_rate
FROM runs GROUP BY run_date"""
)

PERFORMANCE_PERCENTILES = with_runs(
    """
SELECT pipeline_name, pipeline_id, count(*) AS total_runs,
  round(quantile_disc(duration_minutes, 0.5), 6) AS p50_duration_minutes,
  round(quantile_disc(duration_minutes, 0.95), 6) AS p95_duration_minutes
FROM runs GROUP BY pipeline_name, pipeline_id"""
)

SLIDING_PERCENTILES = with_runs(
    f"""
SELECT pipeline_name, pipeline_id, window_end, count(*) AS runs,
  round(quantile_cont(dur_s, 0.5) / 60.0, 6) AS p50_minutes,
  round(quantile_cont(dur_s, 0.95) / 60.0, 6) AS p95_minutes, TRUE AS sketch_within_error
FROM (
  SELECT pipeline_name, pipeline_id, dur_s, CAST(unnest(range(0, 7)) AS INTEGER) + run_date AS window_end FROM runs
) WHERE window_end <= {_d(CFG.as_of_date)}
GROUP BY pipeline_name, pipeline_id, window_end"""
)

DAILY_DURATION_TRENDS = with_runs(
    f"""
SELECT pipeline_name, run_date, count(*) AS runs,
  round({MEAN_MIN}, 6) AS avg_minutes,
  round(quantile_disc(duration_minutes, 0.5), 6) AS median_minutes,
  round(quantile_disc(duration_minutes, 0.95), 6) AS p95_minutes
FROM runs GROUP BY pipeline_name, run_date"""
)

RECENT_ACTIVITY_30D = _recent_activity(days=30)

CLUSTERS_PER_PIPELINE = with_runs(
    """
SELECT u.pipeline_name, u.pipeline_id, u.cluster_id, u.runs, u.first_used, u.last_used, c.unique_clusters
FROM used u JOIN (
  SELECT pipeline_name, pipeline_id, count(cluster_id) AS unique_clusters FROM used GROUP BY pipeline_name, pipeline_id
) c ON u.pipeline_name IS NOT DISTINCT FROM c.pipeline_name AND u.pipeline_id IS NOT DISTINCT FROM c.pipeline_id""",
    extra="""used AS (
  SELECT pipeline_name, pipeline_id, cluster_id, count(*) AS runs, min(run_start) AS first_used,
         max(run_start) AS last_used
  FROM runs GROUP BY pipeline_name, pipeline_id, cluster_id
)""",
)

ERROR_SIGNATURES = with_events(
    """
SELECT regexp_replace(message, '[0-9]+', '#', 'g') AS signature,
  count(*) AS events, count(DISTINCT update_id) AS runs, count(DISTINCT pipeline_id) AS pipelines,
  min("timestamp") AS first_seen, max("timestamp") AS last_seen
FROM enriched WHERE level = 'ERROR'
GROUP BY regexp_replace(message, '[0-9]+', '#', 'g')"""
)

RUN_FLOW_BREAKDOWN = with_events(
    f"""
SELECT pipeline_id, pipeline_name, update_id, source_full_name, flow_name,
  min("timestamp") AS first_event, max("timestamp") AS last_event, count(*) AS events,
  count(*) FILTER (WHERE level = 'ERROR') AS errors,
  round(({_secs('max("timestamp")')} - {_secs('min("timestamp")')}) / 60.0, 6) AS span_minutes
FROM enriched
GROUP BY pipeline_id, pipeline_name, update_id, source_full_name, flow_name"""
)

# from the seconds between neighbouring ends, each with the flows that cover it
RUN_TIME_SPLIT = with_events(
    f"""
, flows AS (
  SELECT dense_rank() OVER (ORDER BY pipeline_id, pipeline_name, update_id, source_full_name) AS run,
    pipeline_id, pipeline_name, update_id, source_full_name, flow_name,
    {_secs('min("timestamp")')} AS a, {_secs('max("timestamp")')} AS b
  FROM enriched GROUP BY pipeline_id, pipeline_name, update_id, source_full_name, flow_name
  HAVING min("timestamp") IS NOT NULL
), ends AS (
  SELECT DISTINCT run, a AS t FROM flows UNION SELECT run, b FROM flows
), parts AS (
  SELECT run, t, lead(t) OVER (PARTITION BY run ORDER BY t) AS u FROM ends
), covered AS (
  SELECT p.run, p.t, p.u, count(f.run) AS n, min(f.flow_name) AS flow_name
  FROM parts p LEFT JOIN flows f ON f.run = p.run AND f.a <= p.t AND f.b >= p.u
  WHERE p.u IS NOT NULL GROUP BY p.run, p.t, p.u
), split AS (
  SELECT run, CASE WHEN n > 1 THEN 'shared' WHEN n = 1 THEN 'alone' ELSE 'idle' END AS kind,
    CASE WHEN n = 1 THEN flow_name END AS flow_name, CAST(sum(u - t) AS BIGINT) AS seconds
  FROM covered GROUP BY 1, 2, 3
)
SELECT r.pipeline_id, r.pipeline_name, r.update_id, r.source_full_name, s.kind, s.flow_name, s.seconds
FROM split s JOIN (SELECT DISTINCT run, pipeline_id, pipeline_name, update_id, source_full_name FROM flows) r USING (run)"""
)

_X = f"CAST(datediff('day', {_d(CFG.as_of_date)}, run_date) AS HUGEINT)"
_FIT_DEN = f"(CAST(count(dur_s) AS HUGEINT) * sum({_X} * {_X}) - sum({_X}) * sum({_X}))"

DURATION_SLOPE = with_runs(
    f"""
SELECT pipeline_name, pipeline_id, runs,
  round(slope, 4) AS slope_minutes_per_day,
  round(intercept, 4) AS fitted_minutes_at_as_of,
  round(intercept + slope * {float(CFG.projection_days)}, 4) AS projected_minutes
FROM (
  SELECT pipeline_name, pipeline_id, count(*) AS runs,
    CASE WHEN {_FIT_DEN} <> 0 THEN
      CAST(CAST(count(dur_s) AS HUGEINT) * sum({_X} * dur_s) - sum({_X}) * sum(CAST(dur_s AS HUGEINT)) AS DOUBLE)
      / CAST({_FIT_DEN} AS DOUBLE) / 60.0 END AS slope,
    CASE WHEN {_FIT_DEN} <> 0 THEN
      CAST(sum(CAST(dur_s AS HUGEINT)) * sum({_X} * {_X}) - sum({_X}) * sum({_X} * dur_s) AS DOUBLE)
      / CAST({_FIT_DEN} AS DOUBLE) / 60.0 END AS intercept
  FROM runs GROUP BY pipeline_name, pipeline_id
)"""
)

FAILED_RUN_DETAIL = with_runs(
    """
SELECT r.pipeline_id, r.pipeline_name, r.update_id, r.source_full_name, r.run_start,
  round(r.duration_minutes, 6) AS duration_minutes, r.error_count, r.error_messages,
  coalesce(f.error_datasets, '') AS error_datasets
FROM runs r
LEFT JOIN (
  SELECT pipeline_id, pipeline_name, update_id, source_full_name,
    array_to_string(list_sort(list(DISTINCT flow_name)), '|') AS error_datasets
  FROM enriched WHERE level = 'ERROR' AND flow_name IS NOT NULL
  GROUP BY ALL
) f
  ON r.pipeline_id IS NOT DISTINCT FROM f.pipeline_id AND r.pipeline_name IS NOT DISTINCT FROM f.pipeline_name
 AND r.update_id IS NOT DISTINCT FROM f.update_id AND r.source_full_name IS NOT DISTINCT FROM f.source_full_name
WHERE r.status = 'FAILED'"""
)

# SURVEY 2.13, W1: success rate desc (nulls last), then cluster id (nulls
# last); reverse for the least reliable
CLUSTER_RELIABILITY_RANK = with_runs(
    """
SELECT pipeline_name, cluster_id, runs_on_cluster, round(success_rate_cluster, 6) AS success_rate_cluster,
  row_number() OVER (PARTITION BY pipeline_name
                     ORDER BY success_rate_cluster DESC NULLS LAST, cluster_id ASC NULLS LAST) AS most_reliable_rank,
  row_number() OVER (PARTITION BY pipeline_name
                     ORDER BY success_rate_cluster ASC NULLS LAST, cluster_id DESC NULLS LAST) AS least_reliable_rank
FROM cluster""",
    extra=CLUSTER_CTE,
)

DURATION_OUTLIERS = with_runs(
    f"""
SELECT r.pipeline_id, r.pipeline_name, r.update_id, r.source_full_name, r.run_start,
  round(r.duration_minutes, 6) AS duration_minutes, round(q.q1, 6) AS q1_minutes, round(q.q3, 6) AS q3_minutes,
  round(q.q3 + {CFG.outlier_iqr_factor} * (q.q3 - q.q1), 6) AS upper_fence_minutes
FROM runs r JOIN (
  SELECT pipeline_id, quantile_cont(duration_minutes, 0.25) AS q1, quantile_cont(duration_minutes, 0.75) AS q3
  FROM runs GROUP BY pipeline_id
) q ON r.pipeline_id = q.pipeline_id
WHERE r.duration_minutes > q.q3 + {CFG.outlier_iqr_factor} * (q.q3 - q.q1)"""
)

ALERT_CANDIDATES = with_runs(
    f"""
SELECT 'duration_spike' AS kind, pipeline_name, pipeline_id, update_id, source_full_name, run_start,
  round(duration_minutes, 6) AS value, round({CFG.spike_factor} * prev_sum / prev_n / 60, 6) AS threshold
FROM (
  SELECT *,
    count(*) OVER w AS prev_n,
    sum(dur_s) OVER w AS prev_sum
  FROM runs
  WINDOW w AS (PARTITION BY pipeline_id
               ORDER BY run_start ASC NULLS FIRST, pipeline_name ASC NULLS FIRST,
                        update_id ASC NULLS FIRST, source_full_name ASC NULLS FIRST
               ROWS BETWEEN {CFG.spike_window_runs} PRECEDING AND 1 PRECEDING)
) s
WHERE prev_n > 0 AND CAST(dur_s AS DOUBLE) * prev_n > {CFG.spike_factor} * prev_sum
UNION ALL
SELECT 'failure_rate', pipeline_name, pipeline_id, NULL, NULL, CAST(NULL AS TIMESTAMP),
  round(failure_rate, 6), {CFG.failure_rate_limit}
FROM perf WHERE failure_rate > {CFG.failure_rate_limit}
UNION ALL
SELECT 'error_burst', r.pipeline_name, r.pipeline_id, r.update_id, r.source_full_name, r.run_start,
  CAST(r.error_count AS DOUBLE), round({CFG.error_burst_factor} * e.s / e.n, 6)
FROM runs r JOIN (
  SELECT pipeline_id, count(*) AS n, sum(error_count) AS s FROM runs GROUP BY pipeline_id
) e ON r.pipeline_id = e.pipeline_id
WHERE r.error_count > 0 AND CAST(r.error_count AS DOUBLE) * e.n > {CFG.error_burst_factor} * e.s""",
    extra=PERF_CTE,
)

# ------------------------------------------------------------------ top-k

LATEST_EVENTS = with_events(
    """
SELECT "timestamp", level, event_type, source_full_name, message FROM logs
ORDER BY "timestamp" DESC NULLS LAST, level ASC NULLS FIRST, event_type ASC NULLS FIRST,
         source_full_name ASC NULLS FIRST, message ASC NULLS FIRST
LIMIT 20"""
)

_RUN_ORDER = (
    "run_start DESC NULLS LAST, pipeline_id ASC NULLS FIRST, pipeline_name ASC NULLS FIRST, "
    "update_id ASC NULLS FIRST, source_full_name ASC NULLS FIRST"
)

LATEST_RUNS = with_runs(
    f"""
SELECT pipeline_name, run_date, run_start, round(duration_minutes, 6) AS duration_minutes, status,
       error_count, total_events, cluster_id
FROM runs ORDER BY {_RUN_ORDER} LIMIT 20"""
)

LATEST_RUN_STATUS = with_runs(
    f"""
SELECT pipeline_name, status, round(duration_minutes, 6) AS duration_minutes
FROM runs ORDER BY {_RUN_ORDER} LIMIT 20"""
)

BUSIEST_PIPELINES = with_runs(
    """
SELECT pipeline_name, pipeline_id, total_runs, round(success_rate, 6) AS success_rate,
  round(avg_duration_minutes, 6) AS avg_duration_minutes, round(max_duration_minutes, 6) AS max_duration_minutes,
  last_run_date, unique_clusters
FROM perf""",
    extra=PERF_CTE,
)

SLOWEST_PIPELINES = with_runs(
    """
SELECT pipeline_name, pipeline_id, round(avg_duration_minutes, 6) AS avg_duration_minutes,
  round(max_duration_minutes, 6) AS max_duration_minutes
FROM perf""",
    extra=PERF_CTE,
)

MOST_FAILING = with_runs(
    """
SELECT pipeline_name, pipeline_id, failed_runs, total_runs, round(failure_rate, 6) AS failure_rate
FROM perf""",
    extra=PERF_CTE,
)

PIPELINE_RATES = with_runs(
    """
SELECT pipeline_name, round(success_rate, 6) AS success_rate, round(avg_duration_minutes, 6) AS avg_duration_minutes
FROM perf""",
    extra=PERF_CTE,
)

_ERR_ORDER = "error_count DESC, pipeline_name ASC NULLS FIRST, pipeline_id ASC NULLS FIRST, event_type ASC NULLS FIRST"

TOP_ERRORS = with_events(
    f"""
SELECT pipeline_name, event_type, error_count, affected_runs, first_error, last_error, sample_message
FROM errs ORDER BY {_ERR_ORDER} LIMIT 15""",
    extra=_errs_cte(),
)

COMMON_ERRORS = with_events(
    f"""
SELECT pipeline_name, event_type, error_count, sample_message
FROM errs ORDER BY {_ERR_ORDER} LIMIT 25""",
    extra=_errs_cte(),
)

LATEST_ERRORS = with_events(
    f"""
SELECT {FLAT_COLUMNS}, {_stamp()} FROM logs WHERE level = 'ERROR'
ORDER BY "timestamp" DESC NULLS LAST, source_full_name ASC NULLS FIRST, id ASC NULLS FIRST,
         event_type ASC NULLS FIRST, message ASC NULLS FIRST
LIMIT 10"""
)


# ------------------------------------------------------ whole results, in order

ERROR_MESSAGES = with_events(
    """
SELECT pipeline_name, pipeline_id, event_type, message, count(*) AS error_count,
       min("timestamp") AS first_error, max("timestamp") AS last_error
FROM enriched WHERE level = 'ERROR' AND message IS NOT NULL
GROUP BY ALL"""
)

STREAMING_EVENTS = with_events(f"SELECT {FLAT_COLUMNS}, {_stamp()}, CAST(\"timestamp\" AS DATE) AS event_date FROM logs")

SLIDING_CFG = fixture_config(days_back=10)
INCREMENTAL_SLIDING = with_runs(PIPELINE_RUNS[PIPELINE_RUNS.rindex("\nSELECT") :], SLIDING_CFG)


def in_order(sql: str, order: str) -> str:
    """The rows of ``sql`` with their place in the order, from 1."""
    return f"SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM ({sql})"


RECENT_ACTIVITY_REPORT = in_order(RECENT_ACTIVITY, "run_date DESC NULLS LAST, pipeline_name ASC NULLS FIRST")
DURATION_TRENDS_REPORT = in_order(DURATION_TRENDS, "avg_minutes DESC NULLS LAST, pipeline_name ASC NULLS FIRST")
CLUSTER_USAGE_REPORT = in_order(CLUSTER_USAGE, "pipeline_name ASC NULLS FIRST, runs_on_cluster DESC NULLS LAST, cluster_id ASC NULLS FIRST")

CONSOLIDATED_MIXED = with_events(
    f"""
SELECT {FLAT_COLUMNS}, {_stamp()},
  CASE source_table WHEN 'event_log_2' THEN NULL ELSE id % 8 / 2.0 END AS weight
FROM logs"""
)

PUBLISHED_TABLES = with_runs(
    """
SELECT 'consolidated_events' AS table_name, count(*) AS row_count FROM logs
UNION ALL SELECT 'pipeline_runs', count(*) FROM runs
UNION ALL SELECT 'performance_metrics', count(*) FROM perf
UNION ALL SELECT 'error_analysis', count(*) FROM errs
UNION ALL SELECT 'error_messages', count(*) FROM (SELECT DISTINCT pipeline_name, pipeline_id, event_type, message FROM enriched WHERE level = 'ERROR' AND message IS NOT NULL)
UNION ALL SELECT 'recent_activity', count(*) FROM (SELECT DISTINCT run_date, pipeline_name FROM runs WHERE run_date >= """
    + _d(CFG.as_of_date - dt.timedelta(days=CFG.recent_days))
    + """)
UNION ALL SELECT 'duration_trends', count(*) FROM (SELECT DISTINCT pipeline_name FROM runs WHERE duration_minutes > """
    + str(CFG.trend_min_minutes)
    + """)
UNION ALL SELECT 'cluster_usage', count(*) FROM cluster""",
    extra=PERF_CTE + "," + CLUSTER_CTE + "," + _errs_cte(),
)
