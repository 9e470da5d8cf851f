"""Plan shape: filters reach the scans, one shuffle for the run fold, no
Python UDF anywhere, top-k planned as TakeOrderedAndProject."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from runlens.plans import registry
from runlens.plans.pipeline import Pipeline
from tests.conftest import SF001


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_time_cutoff_pushed_to_every_scan(spark):
    p = Pipeline.from_fixture(spark, SF001)
    text = plan(p.enriched)
    assert text.count("PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,") == 3


def test_scan_reads_only_needed_columns(spark):
    p = Pipeline.from_fixture(spark, SF001)
    text = plan(p.runs)
    assert "props" not in text  # details column pruned away for runs


def test_run_fold_is_one_shuffle(spark):
    p = Pipeline.from_fixture(spark, SF001)
    assert plan(p.runs).count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", ["latest_events", "latest_runs", "top_errors", "latest_errors"])
def test_topk_is_take_ordered(spark, name):
    assert "TakeOrderedAndProject" in plan(E.queries()[name](spark, SF001))


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - {"streaming_runs", "streaming_events", "publish_roundtrip", "published_tables", "log_inventory", "log_inventory_listed", "scan_log"}))
def test_no_python_udf(spark, name):
    text = plan(E.queries()[name](spark, SF001))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in text
