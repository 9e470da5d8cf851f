"""Discovery (S1-S6, P13-P15; M25-M29) over a session-catalog fixture."""

from __future__ import annotations

import pytest

from runlens.sources.fixture import fixture_config
from runlens.session import new_scratch
from runlens.sources.inventory import discover, inventory_by_catalog, log_row_counts, readable_logs
from tests.conftest import make_log, run_of


@pytest.fixture(scope="module")
def catalog(spark):
    root = new_scratch(spark, "inventory-test")
    log = make_log(spark, run_of([0, 10, 20])).df
    for db in ("invt_a", "invt_b", "invt_h"):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{db}` LOCATION '{root}/{db}'")
    log.write.mode("overwrite").saveAsTable("invt_a.event_log_a")
    log.write.mode("overwrite").saveAsTable("invt_b.PIPELINE_EVENT_LOG_B")
    log.limit(1).write.mode("overwrite").saveAsTable("invt_b.orders")
    log.write.mode("overwrite").saveAsTable("invt_h.event_log_h")
    # a view whose source is gone: listed, but cannot be analysed
    log.write.mode("overwrite").saveAsTable("invt_a.gone")
    spark.sql("CREATE OR REPLACE VIEW invt_a.event_log_broken AS SELECT * FROM invt_a.gone")
    spark.sql("DROP TABLE invt_a.gone")
    log.createOrReplaceTempView("event_log_tmp")
    return root


def _inv(spark, **kw):
    cfg = fixture_config(target_catalogs=("spark_catalog",), schema_filter="invt", **kw)
    return {(r["schema"], r["table"]): r for r in discover(spark, cfg).collect()}


def test_discovery_finds_logs_case_insensitively_and_skips_others(spark, catalog):
    inv = _inv(spark)
    names = {k for k, r in inv.items() if r["status"] == "ok"}
    # M27 lower-cased substring; S4 temp view skipped
    assert names == {("invt_a", "event_log_a"), ("invt_b", "pipeline_event_log_b"), ("invt_h", "event_log_h")}
    assert all(t != "event_log_tmp" for _, t in inv)
    assert all(t != "orders" for _, t in inv)


def test_unreadable_log_is_reported_not_dropped(spark, catalog):
    # Failure becomes a status row
    inv = _inv(spark)
    assert inv[("invt_a", "event_log_broken")]["status"] == "error"
    assert inv[("invt_a", "event_log_broken")]["reason"]


def test_schema_regex_is_start_anchored(spark, catalog):
    # Re.match semantics
    cfg = fixture_config(target_catalogs=("spark_catalog",), schema_filter="nvt")
    assert discover(spark, cfg).count() == 0
    cfg = fixture_config(target_catalogs=("spark_catalog",), schema_filter="invt_b")
    assert {r["table"] for r in discover(spark, cfg).collect()} == {"pipeline_event_log_b"}


def test_row_counts_in_one_job(spark, catalog):
    inv = discover(spark, fixture_config(target_catalogs=("spark_catalog",), schema_filter="invt"))
    logs = readable_logs(spark, inv)
    counts = log_row_counts(logs)
    assert {r["table"]: r["row_count"] for r in counts.collect()} == {
        "event_log_a": 3,
        "pipeline_event_log_b": 3,
        "event_log_h": 3,
    }
    by_cat = inventory_by_catalog(counts).collect()
    assert [(r["catalog"], r["table_count"], r["total_rows"]) for r in by_cat] == [("spark_catalog", 3, 9)]
    # one job: a single Union of global aggregates
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan


def test_inventory_with_counts(spark, catalog):
    from runlens.sources.inventory import inventory_with_counts

    inv = inventory_with_counts(spark, discover(spark, fixture_config(target_catalogs=("spark_catalog",), schema_filter="invt")))
    got = {r["table"]: (r["status"], r["row_count"]) for r in inv.collect()}
    assert got["event_log_a"] == ("ok", 3)
    assert got["event_log_broken"] == ("error", None)


def test_catalog_listing_excludes_system_catalogs(spark):
    from runlens.sources.inventory import list_catalogs

    cats = list_catalogs(spark, fixture_config())
    assert "spark_catalog" in cats and "system" not in cats
    assert list_catalogs(spark, fixture_config(catalog_filter="nomatch")) == []


def test_identifiers_are_back_quoted():
    # The built-in session catalog rejects hyphenated schema names, so
    # the quoting used for every SHOW / table read is checked directly
    from runlens.sources.logs import LogSource, quote

    assert quote("my-logs") == "`my-logs`"
    assert quote("a`b") == "`a``b`"
    assert LogSource("c-1", "s-2", "event_log", None).quoted_name == "`c-1`.`s-2`.`event_log`"


class OtherCatalog:
    """The session, with a catalog service that doesn't list schemas and that
    has system catalogs."""

    def __init__(self, spark, fail: str):
        self._spark, self._fail, self.asked = spark, fail, []

    def __getattr__(self, name):
        return getattr(self._spark, name)

    def sql(self, text):
        self.asked.append(text)
        if text.startswith(self._fail):
            raise RuntimeError("not supported by this catalog")
        return self._spark.sql(text)

    @property
    def catalog(self):
        outer = self

        class Names:
            def __getattr__(self, name):
                return getattr(outer._spark.catalog, name)

            def listCatalogs(self):  # noqa: N802
                return [*outer._spark.catalog.listCatalogs(), *[type("C", (), {"name": n})() for n in ("system", "information_schema", "samples", "spark_other")]]

        return Names()


@pytest.fixture
def schemata(spark):
    """information_schema.schemata, with a row for each table of a schema."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS information_schema LOCATION '{new_scratch(spark, 'schemata')}'")
    rows = [(s, t) for s in ("invt_a", "invt_b", "invt_none") for t in range(3)]
    spark.createDataFrame(rows, "schema_name string, n int").write.mode("overwrite").saveAsTable("information_schema.schemata")
    yield
    spark.sql("DROP SCHEMA information_schema CASCADE")


def test_schemas_from_the_information_schema(spark, catalog, schemata):
    # The listing fails, its fallback gives each schema once
    from runlens.sources.inventory import list_schemas

    other = OtherCatalog(spark, "SHOW SCHEMAS")
    assert sorted(list_schemas(other, "spark_catalog")) == ["invt_a", "invt_b", "invt_none"]
    inv = discover(other, fixture_config(target_catalogs=("spark_catalog",), schema_filter="invt")).collect()
    assert {(r.schema, r.table) for r in inv if r.status == "ok"} == {("invt_a", "event_log_a"), ("invt_b", "pipeline_event_log_b")}
    assert [(r.schema, r.reason is not None) for r in inv if r.status == "error" and not r.table] == [("invt_none", True)]
    assert any("information_schema" in q for q in other.asked)


def test_neither_listing_works(spark, catalog):
    (row,) = discover(OtherCatalog(spark, "S"), fixture_config(target_catalogs=("spark_catalog",))).collect()
    assert (row.catalog, row.schema, row.status) == ("spark_catalog", "", "error") and "cannot list schemas" in row.reason


def test_system_catalogs_are_dropped(spark):
    # P14
    from runlens.sources.inventory import list_catalogs

    other = OtherCatalog(spark, "SHOW SCHEMAS")
    assert list_catalogs(other, fixture_config()) == ["spark_catalog", "spark_other"]
    assert set(list_catalogs(other, fixture_config(include_system_catalogs=True))) == {"spark_catalog", "system", "information_schema", "samples", "spark_other"}
    assert list_catalogs(other, fixture_config(include_system_catalogs=True, catalog_filter="sys")) == ["system"]
    assert list_catalogs(other, fixture_config(target_catalogs=("system",))) == ["system"]  # asked for by name
