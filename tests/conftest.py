from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import types as T  # noqa: E402

from runlens import schema as S  # noqa: E402
from runlens.session import build_session  # noqa: E402
from runlens.sources.logs import LogSource  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=4, app="runlens-tests")
    yield s
    s.stop()


ORIGIN_T = T.StructType([T.StructField(f, T.StringType(), True) for f in S.ORIGIN_FIELDS])
LOG_T = T.StructType(
    [
        T.StructField("id", T.LongType(), True),
        T.StructField("timestamp", T.TimestampNTZType(), True),
        T.StructField("level", T.StringType(), True),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("message", T.StringType(), True),
        T.StructField("origin", ORIGIN_T, True),
    ]
)

T0 = dt.datetime(2024, 1, 10, 12, 0, 0)


def ev(
    i: int,
    secs: float,
    level: str = "INFO",
    pipeline_id: str | None = "p1",
    update_id: str | None = "u1",
    pipeline_name: str = "pipe",
    cluster_id: str | None = "c1",
    message: str | None = None,
    event_type: str = "flow_progress",
    flow_name: str | None = "f1",
    ts: dt.datetime | None = None,
):
    """One event-log row; time is ``T0 + secs`` unless ``ts`` is given."""
    stamp = ts if ts is not None else T0 + dt.timedelta(seconds=secs)
    origin = (pipeline_id, pipeline_name, "WORKSPACE", update_id, "fl", flow_name, cluster_id, None, f"r{i}")
    return (i, stamp, level, event_type, message if message is not None else f"{event_type} {i}", origin)


def make_log(spark, rows, name=("cat", "sch", "event_log_x"), schema=LOG_T) -> LogSource:
    return LogSource(*name, spark.createDataFrame(rows, schema))


def run_of(secs_list, **kw):
    return [ev(i, s, **kw) for i, s in enumerate(secs_list)]
