"""Every registered query against its DuckDB oracle (the driver's gate),
at sf0.001 for speed; tools/check_oracle.py runs the same at sf0.01."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from runlens.plans import registry
from tests.conftest import SF001
from tools.check_oracle import TABLES, digest


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF001).toPandas()
    odf = con.execute(E.oracle_sql()[name]).df()
    assert sorted(sdf.columns) == sorted(odf.columns)
    assert len(sdf) == len(odf)
    assert digest(sdf) == digest(odf)


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "success_rate" in df.columns


def test_fixture_tables_follow_the_data_folder(spark):
    from tests.conftest import SF01

    small = E.queries()["scan_log"](spark, SF001).count()
    large = E.queries()["scan_log"](spark, SF01).count()
    assert small < large
    assert E.queries()["scan_log"](spark, SF001).count() == small


def test_log_inventory_rows(spark):
    rows = E.queries()["log_inventory"](spark, SF001).collect()
    assert [r["table"] for r in rows] == ["event_log_0", "event_log_1", "event_log_2"]
    assert {r["status"] for r in rows} == {"ok"}
