"""Line dedup against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import pytest

from runlens.llm import entries
from runlens.llm.line_dedup import Repeats, _blocks, _documents, line_places, line_report, lost_lines, without_lines
from tests.conftest import SF001, SF01
from tests.llm.conftest import ODD

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line: str) -> str:
    return line.strip(" \t\n\x0b\f\r").translate(LOWER)


def brute(rows, rules: Repeats) -> dict:
    """(doc_id, text) -> (lines, dropped, kept text)"""
    docs = sorted({(i, t or "") for i, t in rows}, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    holders, first = defaultdict(set), {}
    for d in docs:
        for place, line in enumerate(d[1].split("\n")):
            holders[key(line)].add(d)
            first.setdefault(key(line), (d, place))
    out = {}
    for d in docs:
        lines = d[1].split("\n")
        lost = [len(key(x)) >= rules.least_chars and len(holders[key(x)]) >= rules.min_documents and not (rules.keep_first and first[key(x)] == (d, p)) for p, x in enumerate(lines)]
        out[d] = (len(lines), sum(lost), "\n".join(x for x, gone in zip(lines, lost, strict=True) if not gone))
    return out


def corpus(seed: int = 3, n: int = 150) -> list[tuple[int, str]]:
    r = random.Random(seed)
    lines = ["", " ", "Hot line", " hot LINE\t", "É", "é", "日本語 X", "日本語 x", "\x0bhot line\r", *[f"line {i}" for i in range(60)]]
    texts = [["Hot line"] * r.randint(0, 3) + r.choices(lines, k=r.randint(0, 9)) for _ in range(n)]
    texts += [["boiler"] * 200 + ["own"] + ["boiler"] * 70, *[["boiler"]] * 12]
    for t in texts:
        r.shuffle(t)
    return [(i, "\n".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("rules", [Repeats(), Repeats(2), Repeats(3, 4), Repeats(1, 0)])
def test_lines(spark, rules):
    rows = corpus()
    want = brute(rows, rules)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in line_report(docs, rules).collect()}
    assert got == {d[0]: (n, gone, hashlib.sha256(kept.encode()).hexdigest()) for d, (n, gone, kept) in want.items()}
    assert {r.doc_id: r.text for r in without_lines(docs, rules).collect()} == {d[0]: kept for d, (_, _, kept) in want.items()}


def test_first_line_stays(spark):
    """Order of documents is that of their ids; ids are unique here."""
    rules = Repeats(2, 1, keep_first=True)
    docs = spark.createDataFrame(corpus(), "doc_id long, text string").repartition(5)
    assert {r.doc_id: r.text for r in without_lines(docs, rules).collect()} == {d[0]: x[2] for d, x in brute(corpus(), rules).items()}


def test_bitmaps(spark):
    docs = spark.createDataFrame([(i, "\n".join(["x"] * 3 + [f"own {i} {k}" for k in range(130)] + ["x"])) for i in range(3)], "doc_id long, text string")
    for r in lost_lines(docs, Repeats(2)).collect():
        assert [tuple(x) for x in r.lost] == [(0, 0b111), (2, 1 << 5)]  # the second word loses nothing


def test_hot_key_spreads_over_blocks(spark):
    """A key that all documents hold fills several blocks, and counts as one."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(i, "hot" if i % 3 else f"hot\nown {i}\npair {i // 6}") for i in range(600)]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        sizes = Counter(r.block for r in _blocks(line_places(_documents(docs, "doc_id", "text"), Repeats())).collect())
        assert len(sizes) == 9 and max(sizes.values()) < 300
        for rules in (Repeats(600), Repeats(601), Repeats(2, 1, True)):
            want = {d[0]: x[:2] for d, x in brute(rows, rules).items()}
            assert {r.doc_id: (r.n_lines, r.n_dropped) for r in line_report(docs, rules).collect()} == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_odd_rows(spark, odd_docs):
    rules = Repeats(2)
    want = brute([(x[0], x[1]) for x in ODD], rules)
    got = Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in line_report(odd_docs, rules).collect())
    assert got == Counter((i, *want[i, t or ""][:2], hashlib.sha256(want[i, t or ""][2].encode()).hexdigest()) for i, t, *_ in ODD)
    out = without_lines(odd_docs, rules)
    assert out.columns == odd_docs.columns
    assert Counter((r.doc_id, r.text, r.lang, r.shard) for r in out.collect()) == Counter((i, t if t is None else want[i, t][2], lang, "clash") for i, t, lang, _ in ODD)
    for f in (line_report, without_lines, lost_lines):
        assert f(odd_docs.limit(0)).collect() == []


def test_query_on_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    want = {d[0]: (n, gone, hashlib.sha256(kept.encode()).hexdigest()) for d, (n, gone, kept) in brute(rows, Repeats()).items()}
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in entries.op13_line_dedup(spark, SF001).collect()} == want


def test_no_python_on_the_path(spark):
    plan = line_report(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF01}/documents.parquet')")
    assert sorted(map(tuple, entries.op13_line_dedup(spark, SF01).collect())) == sorted(con.execute(entries.oracle_sql()["op13_line_dedup"]).fetchall())
