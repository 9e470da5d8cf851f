"""Importance resampling and its radix sort against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from runlens.llm import entries, radix, resampling
from runlens.llm.resampling import Resampling, crc32_of, features, resampled, resampling_report
from tests.conftest import SF001, SF01
from tests.llm.conftest import ODD

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text: str | None, k: int) -> tuple[list[int], int]:
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return [zlib.crc32(" ".join(words[i : i + n]).encode()) for n in range(1, k + 1) for i in range(len(words) - n + 1)], len(words)


def brute(docs, target, rules: Resampling) -> list[tuple]:
    """(doc_id, n_features, weight, score, rank)"""
    s, t = Counter(), Counter()
    found = [(i, *grams(x, rules.most_words)) for i, x in docs]
    for _, g, _ in found:
        s.update(c % rules.buckets for c in g)
    for x in target:
        t.update(c % rules.buckets for c in grams(x, rules.most_words)[0])
    S, T = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (S + rules.buckets) / ((s[b] + 1) * (T + rules.buckets))))

    rows = []
    for i, g, n in found:
        h = int(hashlib.sha256(f"{rules.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(c % rules.buckets) for c in g)
        rows.append([i, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n])
    order = sorted((r for r in rows if r[4] >= rules.least_words), key=lambda r: (-r[3], math.inf if r[0] is None else r[0]))
    ranks = {id(r): k + 1 for k, r in enumerate(order[: len(order) * rules.percent // 100])}
    return [(*r[:4], ranks.get(id(r))) for r in rows]


def test_crc():
    r = random.Random(1)
    spans = [bytes(r.randrange(256) for _ in range(r.choice([0, 1, 2, 5, 64, 65, 300]))) for _ in range(200)]
    at = np.concatenate([[0], np.cumsum([len(x) for x in spans])])
    data = np.frombuffer(b"".join(spans), np.uint8)
    assert crc32_of(data, at[:-1], at[1:]).tolist() == [zlib.crc32(x) for x in spans]


@pytest.mark.parametrize("k", [1, 3])
def test_parts_of_long_texts(monkeypatch, k):
    """Cuts inside a text lose and double no feature."""
    monkeypatch.setattr(resampling, "PART_BYTES", 37)
    rules = Resampling(most_words=k)
    r = random.Random(k)
    texts = ["".join(r.choice("aB1é-. \n日") for _ in range(r.randint(0, 400))) for _ in range(40)] + ["x" * 200, None, ""]
    got = [Counter() for _ in texts]
    words = np.zeros(len(texts), dtype=np.int64)
    for of, found, n in features(pa.array(texts), rules):
        for i, b in zip(of.tolist(), found.tolist(), strict=True):
            got[i][b] += 1
        words += n
    want = [grams(t, k) for t in texts]
    assert got == [Counter(c % rules.buckets for c in g) for g, _ in want]
    assert words.tolist() == [n for _, n in want]


@pytest.mark.parametrize("rules", [Resampling(least_words=3, percent=30), Resampling(2, 50, 7, 0, 100), Resampling(percent=0)])
def test_report(spark, corpus, rules):
    docs = [(i * 1_000_003 - 50_000_000, t) for i, t in corpus]
    target = [t for _, t in corpus[::9]] + [None, "Fresh words, 12"]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    items = spark.createDataFrame([(t,) for t in target], "text string")
    want = brute(docs, target, rules)
    assert sorted(map(tuple, resampling_report(frame, items, rules).collect())) == sorted(want)
    chosen = {r[0] for r in want if r[4]}
    assert {r.doc_id for r in resampled(frame, items, rules).collect()} == chosen


def test_odd_rows(spark, odd_docs):
    rules = Resampling(least_words=1, percent=60)
    items = spark.createDataFrame([("long words", "clash"), (None, "clash")], "text string, n string")
    want = brute([(x[0], x[1]) for x in ODD], ["long words", None], rules)
    assert Counter(map(tuple, resampling_report(odd_docs, items, rules).collect())) == Counter(want)
    out = resampled(odd_docs, items, rules)
    assert out.columns == odd_docs.columns
    assert Counter((r.doc_id, r.text, r.shard) for r in out.collect()) == Counter((x[0], x[1], "clash") for x, w in zip(ODD, want, strict=True) if w[4])
    for docs, target in ((odd_docs.limit(0), items), (odd_docs.limit(0), items.limit(0))):
        assert resampling_report(docs, target, rules).collect() == [] == resampled(docs, target, rules).collect()
    none = resampling_report(odd_docs, items.limit(0), rules).collect()
    assert Counter(map(tuple, none)) == Counter(brute([(x[0], x[1]) for x in ODD], [], rules))


@pytest.mark.parametrize("block", [1 << 17, 7])
def test_radix(spark, monkeypatch, block):
    """Ties, negative and far-apart numbers, nulls; blocks of few rows."""
    monkeypatch.setattr(radix, "BLOCK_ROWS", block)
    r = random.Random(block)
    rows = [(r.choice([None, 0, -1, 5, 5, -(2**63), 2**63 - 2, 1 << 40, r.randrange(-9999, 9999)]), r.randrange(40), str(i)) for i in range(300)]
    frame = spark.createDataFrame(rows, "a long, b int, rank_of string").repartition(3)
    got = sorted(radix.ranked(frame, ["b", "a"], "place").collect(), key=lambda x: x.place)
    assert [x.place for x in got] == list(range(1, 301))
    far = lambda a: 2**63 - 1 if a is None else a
    assert [(x.b, far(x.a)) for x in got] == sorted((b, far(a)) for a, b, _ in rows)
    assert sorted(x.rank_of for x in got) == sorted(x[2] for x in rows)
    assert radix.ranked(frame.limit(0), ["a"]).collect() == []
    assert [x.rank for x in radix.ranked(frame.filter("a = 5").select("a"), ["a"]).collect()] == list(range(1, 1 + sum(x[0] == 5 for x in rows)))


def test_query_on_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    items = [r.text for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    assert sorted(map(tuple, entries.op11_importance_resampling(spark, SF001).collect())) == sorted(brute(docs, items, Resampling()))


def test_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    rows = con.execute(resampling.duck_sql()).fetchall()
    assert sorted(map(tuple, entries.op11_importance_resampling(spark, SF01).collect())) == sorted(rows)
