"""Counts measured independently in the survey (FIXTURES.md §2): runs kept
and dropped by the duration floor, status split, and level counts."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from runlens.plans.pipeline import Pipeline

# FIXTURES.md §2 table (sf: kept, FAILED, INCOMPLETE, SUCCESS,
# dropped, ERROR, WARN, METRICS, INFO)
EXPECTED = {
    "0.001": (133, 49, 21, 63, 6, 67, 93, 18, 822),
    "0.01": (1261, 517, 104, 640, 7, 682, 931, 184, 8203),
}


@pytest.mark.parametrize("sf", sorted(EXPECTED))
def test_counts_match_survey_probe(spark, sf):
    d = f"/root/testdata/sf{sf}"
    stages = {r["stage"]: r["row_count"] for r in E.queries()["stage_counts"](spark, d).collect()}
    status = {r["status"]: r["runs"] for r in E.queries()["status_breakdown"](spark, d).collect()}
    levels = {r["level"]: r["count"] for r in Pipeline.from_fixture(spark, d).consolidated.groupBy("level").count().collect()}
    got = (
        stages["runs"], status["FAILED"], status["INCOMPLETE"], status["SUCCESS"],
        stages["run_groups"] - stages["runs"],
        levels["ERROR"], levels["WARN"], levels["METRICS"], levels["INFO"],
    )
    assert got == EXPECTED[sf]
