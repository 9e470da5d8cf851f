"""Wiring from input tables to the analysis DataFrames.

``Pipeline`` holds the lazy chain logs -> consolidated -> enriched -> runs
for one configuration.  Each property builds its plan once per instance,
so queries that share a stage share the same plan object.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from runlens.config import Config
from runlens.operators.enrich import enrich
from runlens.operators.errors import error_state
from runlens.operators.runs import finalize_runs, run_facts, run_state, with_error_detail
from runlens.sources.fixture import fixture_config, fixture_logs
from runlens.sources.logs import LogSource, consolidate


@dataclass
class Pipeline:
    logs: list[LogSource]
    cfg: Config

    @classmethod
    def from_fixture(cls, spark: SparkSession, sf_dir: str, cfg: Config | None = None) -> "Pipeline":
        return cls(fixture_logs(spark, sf_dir), cfg or fixture_config())

    @cached_property
    def consolidated(self) -> DataFrame:
        return consolidate(self.logs, self.cfg)

    @cached_property
    def enriched(self) -> DataFrame:
        return enrich(self.consolidated)

    @cached_property
    def state(self) -> DataFrame:
        return run_state(self.enriched, self.cfg)

    @cached_property
    def runs(self) -> DataFrame:
        return finalize_runs(self.state, self.cfg)

    @cached_property
    def facts(self) -> DataFrame:
        return run_facts(self.enriched, self.cfg)

    @cached_property
    def run_report(self) -> DataFrame:
        """The runs with their error messages as an array."""
        return with_error_detail(self.runs, self.facts)

    @cached_property
    def errors(self) -> DataFrame:
        return error_state(self.enriched)
