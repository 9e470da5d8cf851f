"""Job parameters.  Every relative time filter is taken from ``as_of``;
nothing reads the wall clock, so a refresh is reproducible."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    # reference time for every "last N days" filter and the load stamp; None
    # only where no such time is needed (thresholds alone)
    as_of: dt.datetime | None
    # keep only events with timestamp >= as_of - days_back (None/0: keep all)
    days_back: int | None = 90
    # runs not longer than this (minutes) are dropped as spurious
    min_run_minutes: float = 0.1
    # a run with fewer events than this (and no error) is INCOMPLETE
    incomplete_below_events: int = 5
    # duration trends only look at runs longer than this (minutes)
    trend_min_minutes: float = 1.0
    # recent activity window, in days before as_of (inclusive)
    recent_days: int = 7
    # drop events whose update_id is null before folding runs
    exclude_null_updates: bool = False

    # discovery
    target_catalogs: tuple[str, ...] | None = None
    include_system_catalogs: bool = False
    catalog_filter: str | None = None
    schema_filter: str | None = None
    log_name_pattern: str = "event_log"

    # publishing
    table_prefix: str = "evlog_"
    output_format: str = "parquet"
    # None: write the consolidated table straight from the scan tasks (one
    # file per task and date; right when logs arrive time-ordered).  N:
    # range-partition by (event_date, timestamp) into N partitions first, so
    # each task writes one or two date folders and files are about equal.
    consolidated_files: int | None = None

    # so many segments of a level of the store are merged into one of the next
    # (None: never)
    merge_fanout: int | None = 8

    # alert thresholds (documented wishes of the reference, ours to fix)
    spike_factor: float = 2.0
    spike_window_runs: int = 7
    failure_rate_limit: float = 0.05
    error_burst_factor: float = 3.0
    outlier_iqr_factor: float = 1.5
    projection_days: int = 7

    @property
    def time(self) -> dt.datetime:
        if self.as_of is None:
            raise ValueError("set Config.as_of: this result depends on the reference time")
        return self.as_of

    @property
    def as_of_date(self) -> dt.date:
        return self.time.date()

    @property
    def cutoff(self) -> dt.datetime | None:
        if not self.days_back:
            return None
        return self.time - dt.timedelta(days=self.days_back)


#: Thresholds without a reference time, for operators that need no more.
THRESHOLDS = Config(None)
