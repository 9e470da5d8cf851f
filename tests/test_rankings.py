"""Definitions of the documented rankings and alerts on
hand-made runs: W1 tie-breaks, W2 Tukey fence, W3 spikes/bursts/rates."""

from __future__ import annotations

import datetime as dt

from runlens.sources.fixture import fixture_config
from runlens.operators import ranking as R
from runlens.operators import reports as X
from runlens.operators.enrich import enrich
from runlens.operators.runs import pipeline_runs
from runlens.sources.logs import consolidate
from tests.conftest import T0, ev, make_log

CFG = fixture_config(as_of=dt.datetime(2024, 1, 31), days_back=None)


def run_events(spark, specs):
    """specs: (update_id, start offset s, duration s, cluster, errors, pipeline_id)."""
    rows, i = [], 0
    for upd, start, dur, cluster, errors, pid in specs:
        levels = ["ERROR"] * errors + ["INFO"] * max(5 - errors, 0)
        offs = [start + dur * k / max(len(levels) - 1, 1) for k in range(len(levels))]
        for lvl, off in zip(levels, offs):
            rows.append(ev(i, off, level=lvl, update_id=upd, cluster_id=cluster, pipeline_id=pid))
            i += 1
    return pipeline_runs(enrich(consolidate([make_log(spark, rows)], CFG)), CFG)


def test_cluster_reliability_tie_breaks(spark):
    specs = []
    n = 0

    def add(cluster, ok, failed):
        nonlocal n
        for _ in range(ok):
            specs.append((f"u{n}", n * 1000, 600, cluster, 0, "p1")); n += 1
        for _ in range(failed):
            specs.append((f"u{n}", n * 1000, 600, cluster, 1, "p1")); n += 1

    add("c1", 2, 0)   # rate 1.0
    add("c2", 3, 0)   # rate 1.0: after c1, by id
    add("c3", 1, 1)   # rate 0.5
    add("c4", 2, 2)   # rate 0.5
    add(None, 0, 5)   # no cluster: rate 0, ranked too
    got = {r["cluster_id"]: (r["most_reliable_rank"], r["least_reliable_rank"], r["runs_on_cluster"]) for r in R.cluster_reliability_rank(run_events(spark, specs)).collect()}
    assert got == {"c1": (1, 5, 2), "c2": (2, 4, 3), "c3": (3, 3, 2), "c4": (4, 2, 4), None: (5, 1, 5)}


def test_tukey_outliers(spark):
    durs = [600, 610, 620, 630, 640, 650, 660, 6000]
    runs = run_events(spark, [(f"u{i}", i * 10000, d, "c1", 0, "p1") for i, d in enumerate(durs)])
    out = X.duration_outliers(runs, CFG).collect()
    assert [round(r["duration_minutes"] * 60) for r in out] == [6000]
    q1, q3 = out[0]["q1_minutes"], out[0]["q3_minutes"]
    import numpy as np

    m = np.array(durs) / 60
    assert abs(q1 - np.percentile(m, 25)) < 1e-9 and abs(q3 - np.percentile(m, 75)) < 1e-9


def test_duration_spike_uses_seven_preceding_runs(spark):
    durs = [600] * 8 + [1300, 1100]  # 1300 > 2 x 600 spikes; 1100 does not
    runs = run_events(spark, [(f"u{i:02d}", i * 10000, d, "c1", 0, "p1") for i, d in enumerate(durs)])
    spikes = R.duration_spikes(runs, CFG).collect()
    assert [r["update_id"] for r in spikes] == ["u08"]
    assert abs(spikes[0]["threshold"] - 20.0) < 1e-9  # 2 x 10 minutes


def test_error_bursts_and_failure_rate(spark):
    errs = [0, 0, 0, 0, 0, 0, 0, 0, 0, 4]  # mean 0.4 -> 4 > 3 x 0.4
    runs = run_events(spark, [(f"u{i}", i * 10000, 600, "c1", e, "p1") for i, e in enumerate(errs)])
    bursts = R.error_bursts(runs, CFG).collect()
    assert [r["update_id"] for r in bursts] == ["u9"]
    rates = R.failure_rate_alerts(runs, CFG).collect()
    assert len(rates) == 1 and abs(rates[0]["value"] - 0.1) < 1e-12  # 1 failed of 10 > 0.05
    kinds = {r["kind"] for r in R.alert_candidates(runs, CFG).collect()}
    assert kinds == {"error_burst", "failure_rate"}
