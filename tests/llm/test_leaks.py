"""Copies of benchmark items that templates alone don't find."""

from __future__ import annotations

import duckdb
import pytest

from runlens.llm import entries
from runlens.llm.decontamination import Template, leaks, without_leaks
from tests.conftest import SF01

ITEM = "In the morning Alice walks 12 km to the market and buys 3 kg of apples for Bob and 12 more for herself."


def found(spark, docs, items, how):
    docs = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    items = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = leaks(docs, items, how).collect()
    left = {r.doc_id for r in without_leaks(docs, items, how).collect()}
    assert left == {r.doc_id for r in docs.collect()} - {r.doc_id for r in rows}
    return {(r.doc_id, r.item_id): r for r in rows}


@pytest.mark.parametrize("how", [Template(), Template(broadcast_rows=0)])
def test_other_case_and_line_breaks(spark, how):
    german = "Am Abend geht Frau Groß mit Anna Weiß durch die Straße zum Fluß und misst drei Maß Wasser ab."
    copies = [f(f"Before it {x}. {text} so it {x}") for x in ("rained", "snowed") for text in (ITEM, german) for f in (str.upper, str.lower, lambda t: t.replace(" ", "\n"), lambda t: t.replace(" A", "\n  A").replace(" B", "\nB"))]
    rows = found(spark, [*copies, "in the evening nobody walks anywhere and buys 3 kg of apples for nobody at all"], [ITEM, german], how)
    assert set(rows) == {(i, i // 4 % 2) for i in range(len(copies))}
    assert all((r.kind, r.n_changed) == ("verbatim", 0) for r in rows.values())
    assert rows[0, 0].n_matched == rows[0, 0].n_windows == 16


@pytest.mark.parametrize("how", [Template(), Template(broadcast_rows=0)])
def test_items_of_few_words(spark, how):
    items = ["What is 12 plus 7?", "Evaluate 12 + 7 * 3.", "Compute 14 * 23 - 5 + 18 / 6 - 2 * 9.", "", None, "?!"]
    docs = [f"Then they ask: {x} Nobody knows." for x in items[:3]]
    others = [x.replace("12", "13").replace("14", "15") for x in docs]
    rows = found(spark, [*docs, *others, "", None], items, how)
    assert set(rows) == {(0, 0), (1, 1), (2, 2)}
    assert all((r.kind, r.n_windows, r.n_matched) == ("verbatim", 1, 1) for r in rows.values())


@pytest.mark.parametrize("how", [Template(), Template(broadcast_rows=0)])
def test_one_of_two_equal_values_changed(spark, how):
    item = "a train leaves the old station with 12 cars and it goes over the long bridge past the mill and the farms until it stops in the next town where 12 people get off"
    changed = item.replace("12 people", "15 people")
    both = item.replace("12", "15")
    mixed = "they pay 12 for bread and 12 for milk today"
    rows = found(spark, [f"Once {changed} again", f"Once {both} again", f"Once {mixed.replace('12 for milk', '15 for milk')} again"], [item, mixed], how)
    # the windows of the changed place agree among themselves; no window has both
    assert set(rows) == {(0, 0), (1, 0)}
    assert all((r.kind, r.n_matched, r.n_windows) == ("template", 27, 27) for r in rows.values())
    short = "on Monday they pay 12 for bread and 12 for milk and then all of them go home by the same road as before"
    rows = found(spark, [short.replace("12 for milk", "15 for milk")], [short], how)
    assert [(r.n_matched, r.n_windows, r.kind) for r in rows.values()] == [(9, 17, "verbatim")]


def test_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    rows = entries.op10_benchmark_decontamination(spark, SF01).collect()
    assert sorted(map(tuple, rows)) == sorted(con.execute(entries.oracle_sql()["op10_benchmark_decontamination"]).fetchall())
