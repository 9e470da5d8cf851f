"""Publishing refreshes: one scan per source log, stored run state, and
incremental refresh of published tables == full refresh."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from runlens.sources.fixture import fixture_config
from runlens.plans.pipeline import Pipeline
from runlens.plans import refresh as RF
from runlens.plans.refresh import incremental_refresh, refresh
from runlens.session import new_scratch
from runlens.sources.fixture import fixture_logs
from runlens.sources.logs import LogSource, consolidate
from tests.conftest import SF001
from tests.test_properties import _rows


def _split(logs, before: bool):
    cut = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    pick = (F.col("timestamp") < cut) if before else (F.col("timestamp") >= cut)
    return [LogSource(l.catalog, l.schema, l.table, l.df.filter(pick)) for l in logs]


def _sorted(df):
    # doubles to 9 places: averages differ in the last bit with summation order
    def norm(v):
        return repr(round(v, 9)) if isinstance(v, float) else repr(v)

    return sorted(tuple(norm(v) for v in r) for r in df.collect())


TABLES = ("pipeline_runs", "performance_metrics", "error_analysis", "error_messages", "recent_activity", "duration_trends", "cluster_usage")


def _same_tables(spark, got, want):
    for key in TABLES:
        assert _sorted(spark.table(got[key])) == _sorted(spark.table(want[key])), key
    assert spark.table(got["consolidated_events"]).count() == spark.table(want["consolidated_events"]).count()


def _full(spark, name, cfg, logs=None):
    return refresh(spark, logs or fixture_logs(spark, SF001), name, cfg, location=new_scratch(spark, name), views=False)


def test_full_refresh_publishes_all_tables(spark):
    cfg = fixture_config()
    names = _full(spark, "rl_full", cfg)
    assert set(names) == {"consolidated_events", *TABLES}
    # a second full refresh replaces everything (no doubled events)
    names = refresh(spark, fixture_logs(spark, SF001), "rl_full", cfg, views=False)
    p = Pipeline.from_fixture(spark, SF001, cfg)
    assert _rows(spark.table(names["pipeline_runs"])) == _rows(p.run_report)
    assert spark.table(names["consolidated_events"]).count() == p.consolidated.count()
    left = [r["tableName"] for r in spark.sql("SHOW TABLES IN rl_full").collect()]
    assert not [t for t in left if t.endswith("_g1")]  # the old generation is gone


def test_incremental_refresh_equals_full(spark):
    cfg = fixture_config()
    full = _full(spark, "rl_all", cfg)
    _full(spark, "rl_inc", cfg, _split(fixture_logs(spark, SF001), True))
    new = _split(fixture_logs(spark, SF001), False)
    for _ in range(2):  # the same batch again (e.g. a retry after a lost commit ack): no effect
        inc = incremental_refresh(spark, new, "rl_inc", cfg, batch_id=1, views=False)
        _same_tables(spark, inc, full)


@pytest.mark.parametrize(("as_of", "days"), [(dt.datetime(2024, 1, 31), 10), (dt.datetime(2024, 1, 29, 13, 37, 5), 8), (dt.datetime(2024, 1, 31), None)])
def test_window_slides(spark, as_of, days):
    # whole days, a cutoff within a day, and no cutoff
    cfg = fixture_config(as_of, days_back=days)
    name = f"rl_slide_{days}"
    before = fixture_config(dt.datetime(2024, 1, 20), days_back=days)
    _full(spark, name, before, _split(fixture_logs(spark, SF001), True))
    got = incremental_refresh(spark, _split(fixture_logs(spark, SF001), False), name, cfg, batch_id=1, views=False)
    _same_tables(spark, got, _full(spark, name + "_all", cfg))


def test_range_partitioned_consolidated_write(spark):
    import glob

    cfg = fixture_config(consolidated_files=4)
    root = new_scratch(spark, "rl_files")
    names = refresh(spark, fixture_logs(spark, SF001), "rl_files", cfg, location=root, views=False)
    assert spark.table(names["consolidated_events"]).count() == Pipeline.from_fixture(spark, SF001).consolidated.count()
    files = glob.glob(f"{root.replace('file:', '')}/*events_g1/event_date=*/*.parquet")
    # 4 time ranges over 30 days: each range writes its own few date folders
    assert 0 < len(files) <= 30 + 4


def test_what_a_failed_attempt_wrote_is_never_seen(spark, monkeypatch):
    cfg = fixture_config()
    full = _full(spark, "rl_all2", cfg)
    _full(spark, "rl_retry", cfg, _split(fixture_logs(spark, SF001), True))
    new = consolidate(_split(fixture_logs(spark, SF001), False), cfg)
    # the first try holds dates that the retry lacks, and dies before its commit
    orphan = consolidate(fixture_logs(spark, SF001), cfg)
    with monkeypatch.context() as m:
        m.setattr(RF, "error_state", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            RF.apply_events(spark, orphan, "rl_retry", cfg, "manual", 7)
    RF.apply_events(spark, new, "rl_retry", cfg, "manual", 7)
    _same_tables(spark, RF.publish_tables(spark, "rl_retry", cfg), full)


def test_failed_rebuild_leaves_everything(spark):
    cfg = fixture_config()
    names = _full(spark, "rl_atomic", cfg)
    before = {k: _sorted(spark.table(v)) for k, v in names.items() if k != "consolidated_events"}
    n = spark.table(names["consolidated_events"]).count()
    log = spark.table("rl_atomic.evlog_refresh_log").count()
    broken = fixture_logs(spark, SF001)
    broken[1] = LogSource("cat1", "s1", "event_log_1", broken[1].df.withColumn("message", F.raise_error(F.lit("scan failed")).cast("string")))
    with pytest.raises(Exception, match="scan failed"):
        refresh(spark, broken, "rl_atomic", cfg, views=False)
    assert {k: _sorted(spark.table(names[k])) for k in before} == before
    assert spark.table(names["consolidated_events"]).count() == n and spark.table("rl_atomic.evlog_refresh_log").count() == log
    # and a batch goes on from there
    incremental_refresh(spark, fixture_logs(spark, SF001)[:1], "rl_atomic", cfg, batch_id=3, views=False)
    assert spark.table(names["consolidated_events"]).count() > n


def test_batch_with_a_new_column(spark):
    cfg = fixture_config()
    logs = fixture_logs(spark, SF001)
    names = _full(spark, "rl_evolve", cfg, [logs[0]])
    assert "details" not in spark.table(names["consolidated_events"]).columns
    names = incremental_refresh(spark, [logs[2]], "rl_evolve", cfg, batch_id=1, views=False)
    events = spark.table(names["consolidated_events"])
    assert events.count() == consolidate([logs[0], logs[2]], cfg).count()
    assert events.filter("details is not null").count() == logs[2].df.filter("details is not null").count()


def test_batch_costs_what_it_holds(spark):
    import glob

    cfg = fixture_config()
    root = new_scratch(spark, "rl_cost")
    logs = fixture_logs(spark, SF001)
    refresh(spark, logs, "rl_cost", cfg, location=root, views=False)
    day = F.col("timestamp").between(F.lit("2024-01-29").cast("timestamp_ntz"), F.lit("2024-01-30").cast("timestamp_ntz"))

    def files():
        return {f for f in glob.glob(f"{root.replace('file:', '')}/**/*.parquet", recursive=True) if "_g1/" in f}

    written = []
    for i in range(3):
        before = files()
        RF.apply_events(spark, consolidate([LogSource(l.catalog, l.schema, l.table, l.df.filter(day)) for l in logs], cfg), "rl_cost", cfg, "day", i)
        assert before < files()  # nothing is rewritten
        written.append(len(files() - before))
    assert max(written) <= min(written) + 2  # and no more as the history grows


def test_incremental_batches_from_an_empty_database(spark):
    cfg = fixture_config()
    full = _full(spark, "rl_all3", cfg)
    incremental_refresh(spark, _split(fixture_logs(spark, SF001), True), "rl_fresh", cfg, batch_id=1, views=False)
    _same_tables(spark, incremental_refresh(spark, _split(fixture_logs(spark, SF001), False), "rl_fresh", cfg, batch_id=2, views=False), full)
