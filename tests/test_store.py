"""The store: its manifest, merges, schema changes, and the switch of views."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from runlens.plans import refresh as RF
from runlens.plans import store as ST
from runlens.plans.refresh import apply_events, publish_tables, refresh
from runlens.plans.store import Store
from runlens.session import new_scratch
from runlens.sources.fixture import fixture_config, fixture_logs
from runlens.sources.logs import LogSource, consolidate
from runlens.sources.sinks import ensure_schema
from runlens.streaming.monitor import StreamLog, start_run_monitor
from tests.conftest import SF001
from tests.test_refresh import TABLES, _full, _same_tables, _sorted


def slices(logs, n):
    """The logs in n batches, by event id."""
    return [[replace(l, df=l.df.filter(F.col("id") % n == i)) for l in logs] for i in range(n)]


def database(spark, name):
    ensure_schema(spark, name, new_scratch(spark, name))
    return name


def file_logs(spark, root):
    """The fixture logs as files, and as logs that a monitor follows."""
    logs, streams = [], []
    for log in fixture_logs(spark, SF001):
        path = f"{root}/in put/{log.table}"  # a blank: paths are compared as they are written
        log.df.repartition(3).write.parquet(path)
        logs.append(replace(log, df=spark.read.parquet(path)))
        streams.append(StreamLog(log.catalog, log.schema, log.table, path, logs[-1].df.schema))
    return logs, streams


def test_monitor_after_a_narrower_rebuild(spark):
    """What an older generation has read counts no more."""
    cfg = fixture_config()
    root = new_scratch(spark, "narrow")
    logs, streams = file_logs(spark, root)
    want = _full(spark, "rl_wide", cfg, logs)
    names = _full(spark, "rl_narrow", cfg, logs)
    names = refresh(spark, logs[:2], "rl_narrow", cfg, views=False)
    start_run_monitor(spark, streams, "rl_narrow", f"{root}/checkpoint", cfg).awaitTermination()
    _same_tables(spark, names, want)


@pytest.mark.parametrize("step", ["covered", "commit"])
def test_crash_around_the_commit_of_a_rebuild(spark, monkeypatch, step):
    """Events and the files they come from count together or not at all."""
    cfg = fixture_config()
    root = new_scratch(spark, "crash")
    logs, streams = file_logs(spark, root)
    want = _full(spark, f"rl_crash_{step}_all", cfg, logs)
    name = f"rl_crash_{step}"
    _full(spark, name, cfg, logs[:1])
    with monkeypatch.context() as m:
        if step == "commit":
            m.setattr(Store, "commit", lambda *a, **k: 1 / 0)
        else:
            m.setattr(RF, "COVERED_KEY", "no such:name")
        with pytest.raises(Exception):  # noqa: B017
            refresh(spark, logs, name, cfg, views=False)
    start_run_monitor(spark, streams, name, f"{root}/checkpoint", cfg).awaitTermination()
    _same_tables(spark, {k: f"{name}.evlog_{k}" for k in want}, want)
    # committed, but not published: the same again through the next publish
    monkeypatch.setattr(RF, "publish_tables", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        refresh(spark, logs, name, cfg, views=False)
    monkeypatch.undo()
    start_run_monitor(spark, streams, name, f"{root}/checkpoint2", cfg).awaitTermination()
    _same_tables(spark, {k: f"{name}.evlog_{k}" for k in want}, want)


def test_merges_leave_few_segments_and_the_same_tables(spark, monkeypatch):
    monkeypatch.setattr(ST, "ROLL_AFTER", 6)
    cfg = fixture_config(merge_fanout=3)
    name, logs = database(spark, "rl_merge"), fixture_logs(spark, SF001)
    store = Store(spark, name, cfg)
    for i, part in enumerate(slices(logs, 14)):
        for _ in range(2):  # a batch that comes twice is there once
            apply_events(spark, consolidate(part, cfg), name, cfg, "s", i)
        now = store.manifest()
        levels = [len(now.at_level(n)) for n in set(now.segments.values())]
        assert max(levels) < 3 and len(levels) <= 3
        assert store.segments_of(1) >= set(now.segments)  # what was replaced is still there for readers
    assert store.manifest("s", 3).done and store.manifest("s", 13).done and not store.manifest("s", 14).done and not store.manifest("t", 3).done
    assert spark.table(store.name(ST.LOG_KEY)).count() <= 2 * (6 + 7) and store.manifest().era > 2
    full = _full(spark, "rl_merge_all", cfg)
    _same_tables(spark, publish_tables(spark, name, cfg), full)
    assert store.segments_of(1) == set(store.manifest().segments)
    # a cutoff within a day, from merged partials
    cut = fixture_config(merge_fanout=3, days_back=8, as_of=cfg.as_of.replace(hour=5, minute=6))
    _same_tables(spark, publish_tables(spark, name, cut), _full(spark, "rl_merge_cut", cut))


def test_merge_while_a_version_is_read(spark):
    """A version keeps its segments after they have been merged."""
    cfg = fixture_config(merge_fanout=2)
    name, parts = database(spark, "rl_held"), slices(fixture_logs(spark, SF001), 3)
    apply_events(spark, consolidate(parts[0], cfg), name, cfg, "s", 0)
    names = publish_tables(spark, name, cfg)
    held = spark.table(names["consolidated_events"])
    n = held.count()
    apply_events(spark, consolidate(parts[1], cfg), name, cfg, "s", 1)
    assert len(Store(spark, name, cfg).manifest().segments) == 1  # merged
    assert spark.table(names["consolidated_events"]).count() == n
    publish_tables(spark, name, cfg)
    assert held.count() == n < spark.table(names["consolidated_events"]).count()  # a plan made before the switch
    publish_tables(spark, name, cfg)
    publish_tables(spark, name, cfg)
    with pytest.raises(Exception, match="is gone|cannot be found"):
        held.count()


def test_one_switch_for_all_views(spark, monkeypatch):
    """Before the switch every view shows the old version, after it the new."""
    cfg = fixture_config(merge_fanout=None)
    name, parts = database(spark, "rl_switch"), slices(fixture_logs(spark, SF001), 2)
    apply_events(spark, consolidate(parts[0], cfg), name, cfg, "s", 0)
    names = publish_tables(spark, name, cfg)

    def read():
        # `details` is a column as long as a segment that has it can be shown
        return {k: _sorted(spark.table(v).select("id", "timestamp", "message", "origin") if k == "consolidated_events" else spark.table(v)) for k, v in names.items()}

    first, seen = read(), []
    apply_events(spark, consolidate(parts[1], cfg), name, cfg, "s", 1)
    switch = Store.switch

    def spy(self, *a):
        seen.append(read())
        switch(self, *a)
        seen.append(read())

    with monkeypatch.context() as m:  # dies when all is written
        m.setattr(Store, "switch", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            publish_tables(spark, name, cfg)
    assert read() == first
    monkeypatch.setattr(Store, "switch", spy)
    publish_tables(spark, name, cfg)
    last = read()
    assert seen == [first, last] and all(first[k] != last[k] for k in names)
    # a rebuild, with other segments and a column more
    logs = [replace(l, df=l.df.withColumn("note", F.lit("x"))) for l in fixture_logs(spark, SF001)[:1]]
    refresh(spark, logs, name, cfg, views=False)
    assert seen[2:] == [last, read()] and "note" in spark.table(names["consolidated_events"]).columns


def test_segments_come_in_the_order_of_batches(spark):
    """Whatever order the manifest's files are listed in."""
    store = Store(spark, database(spark, "rl_order"), fixture_config())
    for i in range(7):
        store.commit(store.manifest(), "batch", 1, f"s{(5 * i) % 7}", source="s", batch_id=i)
    assert list(store.manifest().segments) == [f"s{(5 * i) % 7}" for i in range(7)]


def test_batches_change_the_schema(spark):
    """New columns, new fields of origin and wider types need no rebuild."""
    cfg = fixture_config(merge_fanout=3)
    logs = fixture_logs(spark, SF001)
    narrow = [replace(l, df=l.df.withColumn("id", F.col("id").cast("int")).withColumn("weight", F.lit(1.5).cast("float"))) for l in slices(logs, 2)[0]]
    wide = [replace(l, df=l.df.withColumn("ID", F.col("id")).withColumn("origin", F.col("origin").withField("region", F.lit("eu"))).withColumn("weight", F.lit(0.1))) for l in slices(logs, 2)[1]]
    full = _full(spark, "rl_types_all", cfg, [*narrow, *wide])
    name = database(spark, "rl_types")
    for i, part in enumerate((narrow, wide)):
        apply_events(spark, consolidate(part, cfg), name, cfg, "s", i)
        names = publish_tables(spark, name, cfg)

    def same():
        _same_tables(spark, names, full)
        got, want = (spark.table(x["consolidated_events"]) for x in (names, full))
        assert got.schema["id"].dataType.simpleString() == "bigint" and got.schema["weight"].dataType.simpleString() == "double"
        assert "region" in got.schema["origin"].dataType.names
        columns = [c for c in want.columns if c != "event_date"]
        assert sorted(got.columns) == sorted(want.columns) and _sorted(got.select(*columns)) == _sorted(want.select(*columns))

    same()
    apply_events(spark, consolidate(narrow, cfg).limit(0), name, cfg, "s", 2)  # the third segment: a merge of all schemas
    publish_tables(spark, name, cfg)
    assert len(Store(spark, name, cfg).manifest().segments) == 1
    same()
    clash = [replace(logs[0], df=logs[0].df.withColumn("id", F.col("id").cast("string")))]
    with pytest.raises(RF.S.SchemaClashError):
        apply_events(spark, consolidate(clash, cfg), name, cfg, "s", 3)
    same()
    # a rebuild may change any type
    names = refresh(spark, clash, name, cfg, views=False)
    assert spark.table(names["consolidated_events"]).schema["id"].dataType.simpleString() == "string"


def test_published_runs_are_bounded_rows(spark):
    """A run with many messages: its stored row holds their number."""
    cfg = fixture_config()
    log = fixture_logs(spark, SF001)[0]
    hot = F.lit("hot")
    df = log.df.withColumn("level", F.lit("ERROR")).withColumn("message", F.concat(F.lit("failed at "), "id"))
    df = df.withColumn("origin", F.col("origin").withField("update_id", hot).withField("pipeline_id", hot).withField("pipeline_name", hot))
    names = _full(spark, "rl_lists", cfg, [replace(log, df=df)])
    n = df.count()
    rows = spark.table("rl_lists.evlog_run_rows")
    assert [t for c, t in rows.dtypes if t.startswith(("array", "map", "struct"))] == []
    assert [(r.n_messages, r.n_flows, r.error_count) for r in rows.collect()] == [(n, 5, n)]
    assert spark.table("rl_lists.evlog_run_facts").count() == n + 5
    (run,) = spark.table(names["pipeline_runs"]).collect()
    assert run.error_messages == sorted(f"failed at {r.id}" for r in df.select("id").collect())


def test_versions_and_generations_go(spark):
    cfg = fixture_config()
    name, logs = database(spark, "rl_gone"), fixture_logs(spark, SF001)
    for i in range(4):
        apply_events(spark, consolidate(logs[:1], cfg), name, cfg, "s", i)
        publish_tables(spark, name, cfg)
    store = Store(spark, name, cfg)
    assert [v.version for v in store.versions()] == [4, 3]
    for key in (*TABLES[1:], "run_rows", "run_facts"):
        assert spark.sql(f"SHOW PARTITIONS {store.name('published_' + key)}").count() == 2
    refresh(spark, logs, name, cfg, views=False)
    assert {t for t, _ in store.tables(r"\w+_g(\d+)")} == {f"evlog_{k}_g2" for k in (*ST.SEGMENT_KEYS, ST.COVERED_KEY)} - ({f"evlog_{ST.COVERED_KEY}_g2"} if not spark.catalog.tableExists(store.name(ST.COVERED_KEY, "g2")) else set())


def test_events_before_the_rebuilds_window_stay_out(spark):
    """A generation holds what its rebuild's window holds, whole."""
    cfg = fixture_config(days_back=10)
    root = new_scratch(spark, "before")
    logs, streams = file_logs(spark, root)
    names = _full(spark, "rl_before", cfg, logs)
    late = fixture_config(days_back=None)
    start_run_monitor(spark, streams, "rl_before", f"{root}/checkpoint", late).awaitTermination()
    inside = consolidate([LogSource(l.catalog, l.schema, l.table, l.df) for l in logs], cfg)
    assert spark.table(names["consolidated_events"]).count() == inside.count()
