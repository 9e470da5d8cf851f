"""Hand-made edge tables (FIXTURES.md §3), one per semantics row M1-M31."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens import schema as S
from runlens.sources.fixture import fixture_config
from runlens.operators import metrics as M
from runlens.operators.enrich import enrich
from runlens.operators.errors import error_messages, error_state
from runlens.operators.runs import pipeline_runs
from runlens.sources.logs import LogSource, consolidate
from tests.conftest import LOG_T, ev, make_log, run_of

CFG = fixture_config(as_of=dt.datetime(2024, 1, 31), days_back=None)


def runs_of(spark, *logs, cfg=CFG):
    return pipeline_runs(enrich(consolidate(list(logs), cfg)), cfg)


def by_update(df):
    return {r["update_id"]: r for r in df.collect()}


def test_two_ends_whole_second_floor_and_duration_floor(spark):
    # M1: endpoints floored first: 0.9 s -> 7.0 s counts 7 s (kept);
    # M2: 0.9 s -> 6.5 s counts 6 s = 0.1 min exactly (dropped); 1 event: 0 s
    rows = (
        run_of([0.9, 7.0], update_id="u7")
        + [ev(10 + i, s, update_id="u6") for i, s in enumerate([0.9, 6.5])]
        + [ev(20, 1.0, update_id="u0")]
    )
    runs = by_update(runs_of(spark, make_log(spark, rows)))
    assert set(runs) == {"u7"}
    assert runs["u7"]["duration_minutes"] == pytest.approx(7 / 60)


def test_status_order(spark):
    # M3: any ERROR -> FAILED (even with < 5 events); else < 5 events -> INCOMPLETE
    rows = (
        [ev(0, 0, update_id="a"), ev(1, 30, update_id="a", level="ERROR")]
        + [ev(10 + i, i * 10, update_id="b") for i in range(4)]
        + [ev(20 + i, i * 10, update_id="c") for i in range(5)]
    )
    runs = by_update(runs_of(spark, make_log(spark, rows)))
    assert runs["a"]["status"] == S.STATUS_FAILED and runs["a"]["has_errors"]
    assert runs["b"]["status"] == S.STATUS_INCOMPLETE
    assert runs["c"]["status"] == S.STATUS_SUCCESS
    perf = M.performance_metrics(runs_of(spark, make_log(spark, rows))).collect()[0]
    # M4: INCOMPLETE counts in total_runs only
    assert (perf["total_runs"], perf["successful_runs"], perf["failed_runs"]) == (3, 1, 1)
    assert perf["success_rate"] + perf["failure_rate"] < 1


def test_null_keys(spark):
    # M6: null update ids form one run per pipeline and source;
    # Events without pipeline id leave the runs but stay consolidated
    rows = [ev(i, i * 10, update_id=None) for i in range(3)] + [ev(10 + i, i * 10, pipeline_id=None) for i in range(3)]
    log = make_log(spark, rows)
    runs = runs_of(spark, log).collect()
    assert len(runs) == 1 and runs[0]["update_id"] is None and runs[0]["total_events"] == 3
    assert consolidate([log], CFG).count() == 6


def test_same_update_in_two_logs_is_two_runs(spark):
    # M7: source_full_name is part of the run key
    rows = run_of([0, 10, 20])
    a = make_log(spark, rows, ("c", "s", "event_log_a"))
    b = make_log(spark, rows, ("c", "s", "event_log_b"))
    runs = runs_of(spark, a, b)
    assert runs.count() == 2
    assert {r["source_full_name"] for r in runs.collect()} == {"c.s.event_log_a", "c.s.event_log_b"}


def test_renamed_pipeline_and_shared_names(spark):
    # M8: one id under two names -> two metric rows; M9: two ids sharing a
    # name merge in trends / cluster usage
    rows = (
        run_of([0, 100], update_id="u1", pipeline_name="old")
        + [ev(10 + i, s, update_id="u2", pipeline_name="new") for i, s in enumerate([0, 100])]
        + [ev(20 + i, s, update_id="u3", pipeline_name="new", pipeline_id="p2") for i, s in enumerate([0, 100])]
    )
    runs = runs_of(spark, make_log(spark, rows))
    assert M.performance_metrics(runs).count() == 3
    trends = {r["pipeline_name"]: r["runs"] for r in M.duration_trends(runs, CFG).collect()}
    assert trends == {"old": 1, "new": 2}


def test_all_null_error_messages(spark):
    # No message -> empty set, not null; M18: sample_message is null, no error
    rows = [ev(i, i * 10, level="ERROR", message=None) for i in range(3)]
    rows = [r[:4] + (None,) + r[5:] for r in rows]
    log = make_log(spark, rows)
    runs = runs_of(spark, log).collect()
    assert runs[0]["error_messages"] == []
    ea = M.error_analysis(enrich(consolidate([log], CFG)), CFG).collect()[0]
    assert ea["error_count"] == 3 and ea["sample_message"] is None


def test_single_run_stddev_is_null(spark):
    # Sample standard deviation of one run
    perf = M.performance_metrics(runs_of(spark, make_log(spark, run_of([0, 60])))).collect()[0]
    assert perf["duration_stddev"] is None and perf["total_runs"] == 1


def test_cutoff_straddle(spark):
    # Inclusive cutoff, null timestamps drop out, 0/None disables;
    # A run straddling the cutoff starts late
    as_of = dt.datetime(2024, 1, 31)
    cut = as_of - dt.timedelta(days=10)
    rows = [
        ev(0, 0, ts=cut - dt.timedelta(seconds=30)),
        ev(1, 0, ts=cut),
        ev(2, 0, ts=cut + dt.timedelta(seconds=60)),
        ev(3, 0, ts=None),
    ]
    rows[3] = rows[3][:1] + (None,) + rows[3][2:]
    log = make_log(spark, rows)
    on = consolidate([log], fixture_config(as_of=as_of, days_back=10))
    assert on.count() == 2
    for off in (0, None):
        assert consolidate([log], fixture_config(as_of=as_of, days_back=off)).count() == 4
    run = pipeline_runs(enrich(on), fixture_config(as_of=as_of, days_back=10)).collect()[0]
    assert run["run_start"] == cut


def test_recent_activity_day_edge(spark):
    # run_date >= as_of - 7 days, inclusive
    as_of = dt.datetime(2024, 1, 31)
    d7 = dt.datetime(2024, 1, 24, 8)
    d8 = dt.datetime(2024, 1, 23, 8)
    rows = [ev(0, 0, ts=d7, update_id="a"), ev(1, 0, ts=d7 + dt.timedelta(minutes=5), update_id="a")]
    rows += [ev(2, 0, ts=d8, update_id="b"), ev(3, 0, ts=d8 + dt.timedelta(minutes=5), update_id="b")]
    cfg = fixture_config(as_of=as_of, days_back=None)
    ra = M.recent_activity(runs_of(spark, make_log(spark, rows), cfg=cfg), cfg).collect()
    assert [r["run_date"] for r in ra] == [dt.date(2024, 1, 24)]


def test_lower_case_levels_only_in_total(spark):
    # Levels are matched case-sensitively; others count only in total
    rows = [ev(0, 0, level="error"), ev(1, 10, level="Warn"), ev(2, 20, level="METRICS"), ev(3, 30, level="INFO")]
    r = runs_of(spark, make_log(spark, rows)).collect()[0]
    assert (r["total_events"], r["error_count"], r["warning_count"], r["info_count"]) == (4, 0, 0, 1)
    assert r["status"] == S.STATUS_INCOMPLETE


def test_first_cluster_is_earliest_non_null(spark):
    # Deterministic replacement of first(): earliest event with a cluster
    rows = [ev(0, 0, cluster_id=None), ev(1, 10, cluster_id="late"), ev(2, 5, cluster_id="early")]
    df = make_log(spark, rows).df.repartition(3)
    r = runs_of(spark, LogSource("cat", "sch", "event_log_x", df)).collect()[0]
    assert r["cluster_id"] == "early"


def test_union_fills_missing_columns_at_both_depths(spark):
    # A log without origin.batch_id and a log with an extra column
    a = make_log(spark, run_of([0, 10]), ("c", "s", "event_log_a"))
    narrow_origin = T.StructType([f for f in LOG_T["origin"].dataType.fields if f.name != "batch_id"])
    fields = [T.StructField(f.name, narrow_origin if f.name == "origin" else f.dataType) for f in LOG_T.fields]
    rows_b = [r[:5] + (tuple(v for k, v in zip(S.ORIGIN_FIELDS, r[5]) if k != "batch_id"),) + ("x",) for r in run_of([0, 10])]
    b_schema = T.StructType(fields + [T.StructField("details", T.StringType())])
    b = LogSource("c", "s", "event_log_b", spark.createDataFrame(rows_b, b_schema))
    c = consolidate([a, b], CFG)
    assert c.count() == 4
    got = {
        r["source_table"]: (r["nd"], r["nb"])
        for r in c.groupBy("source_table")
        .agg(F.count_if(F.col("details").isNull()).alias("nd"), F.count_if(F.col("origin.batch_id").isNull()).alias("nb"))
        .collect()
    }
    assert got == {"event_log_a": (2, 2), "event_log_b": (0, 2)}


def test_type_clash_is_a_clear_error(spark):
    # §1.2: id bigint vs string; origin struct vs string
    a = make_log(spark, run_of([0]), ("c", "s", "event_log_a"))
    str_id = T.StructType([T.StructField("id", T.StringType())] + LOG_T.fields[1:])
    b = LogSource("c", "s", "event_log_b", spark.createDataFrame([("x",) + run_of([0])[0][1:]], str_id))
    with pytest.raises(S.SchemaClashError, match="column id"):
        consolidate([a, b], CFG)
    flat = T.StructType(LOG_T.fields[:5] + [T.StructField("origin", T.StringType())])
    c = LogSource("c", "s", "event_log_c", spark.createDataFrame([run_of([0])[0][:5] + ("o",)], flat))
    with pytest.raises(S.SchemaClashError, match="origin"):
        consolidate([a, c], CFG)


def test_wrong_type_of_a_required_column_is_a_clear_error(spark):
    bad = T.StructType([f if f.name != "level" else T.StructField("level", T.IntegerType()) for f in LOG_T.fields])
    rows = [r[:2] + (1,) + r[3:] for r in run_of([0, 10])]
    log = LogSource("c", "s", "event_log_a", spark.createDataFrame(rows, bad))
    with pytest.raises(S.SchemaClashError, match="column level is int"):
        consolidate([log], CFG)


def test_every_message_is_kept(spark):
    # all messages of a group, however many, with counts and times
    rows = [ev(i, 100 - i, level="ERROR", message=f"m{i % 20:03d}") for i in range(30)]
    enriched = enrich(consolidate([make_log(spark, rows)], CFG))
    ea = M.error_analysis(enriched).collect()[0]
    assert ea["sample_message"] == "m009" and ea["error_count"] == 30
    got = {r["message"]: (r["error_count"], r["first_error"] <= r["last_error"]) for r in error_messages(error_state(enriched)).collect()}
    assert got == {f"m{i:03d}": (2 if i < 10 else 1, True) for i in range(20)}


def test_by_name_union_widens_and_ignores_case(spark):
    wide = T.StructType([T.StructField("ID", T.LongType()) if f.name == "id" else T.StructField(f.name.upper(), f.dataType) if f.name == "level" else f for f in LOG_T.fields])
    narrow = T.StructType([T.StructField("id", T.IntegerType()) if f.name == "id" else f for f in LOG_T.fields])
    a = LogSource("c", "s", "a", spark.createDataFrame(run_of([0, 10]), narrow))
    b = LogSource("c", "s", "b", spark.createDataFrame([(2**40, *ev(0, 5)[1:])], wide))
    df = consolidate([a, b], CFG)
    assert [c.lower() for c in df.columns].count("id") == 1 and df.schema["id"].dataType == T.LongType() and "level" in df.columns
    assert sorted(r["id"] for r in df.collect()) == [0, 1, 2**40]


def test_exclude_null_updates_drops_only_that_run(spark):
    rows = [ev(i, i * 10, update_id=None) for i in range(3)] + [ev(10 + i, i * 10, update_id="u1") for i in range(3)]
    log = make_log(spark, rows)
    keep = runs_of(spark, log).collect()
    cfg = fixture_config(as_of=CFG.as_of, days_back=None, exclude_null_updates=True)
    drop = runs_of(spark, log, cfg=cfg).collect()
    assert sorted(r["update_id"] or "" for r in keep) == ["", "u1"]
    assert [r["update_id"] for r in drop] == ["u1"]
