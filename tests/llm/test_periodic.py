"""Periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import time
import zlib

import numpy as np
import pytest

from runlens.llm import entries, periodic_runs
from runlens.llm.periodic_runs import Periodic, collapsed, cycled, lag_scan, run_report, runs_of, survivors, with_cycles, word_ids
from tests.conftest import SF001
from tests.llm.conftest import ODD


def brute(words, least=6, times=4):
    """All runs, from the definition: for each period the maximal stretches,
    the smallest period first."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, times * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def report(doc_id, text):
    """The contract's row, from words."""
    w = (text or "").encode().split()
    h, n = (zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1), len(w)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    digest = hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest()
    kept = hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()
    return (doc_id, len(runs), *((*top, 1000 * top[1] // top[2]) if top else (None,) * 4), digest, kept)


def sequences():
    r = random.Random(5)
    yield []
    yield [0] * 5
    yield [0] * 6
    yield [0] * 400
    yield [0, 1] * 100 + [1] * 9 + [2, 0, 1] * 20
    yield ([0] * 6 + [1]) * 8  # runs within a run
    yield ([0, 1] * 5 + [2]) * 4 + [0, 1] * 5
    for _ in range(300):
        out = []
        for _ in range(r.randint(1, 6)):
            unit = [r.randrange(r.choice([1, 2, 3, 9])) for _ in range(r.randint(1, 12))]
            out += unit * r.randint(1, 7) + unit[: r.randint(0, len(unit))] + [r.randrange(30) for _ in range(r.randint(0, 5))]
        yield out


@pytest.mark.parametrize("rules", [Periodic(), Periodic(1, 3), Periodic(20, 5), Periodic(2, 4)])
def test_runs(rules):
    for seq in sequences():
        ids = np.array(seq, dtype=np.int32)
        want = brute(seq, rules.least_length, rules.times)
        assert runs_of(ids, rules) == want, seq
        assert sorted(lag_scan(ids, rules)) == want, seq  # splitting loses nothing


def test_survivors():
    ids = np.array([9, 0, 1, 0, 1, 0, 1, 0, 1, 8, 0, 1, 0, 1, 7, *[2] * 7], dtype=np.int32)
    assert survivors(ids, Periodic()) == [(1, 9), (15, 22)]  # 0 and 1 are frequent in the text, but not in 10..14


def test_hash_collisions_change_nothing(monkeypatch):
    monkeypatch.setattr(periodic_runs.A, "mixed", lambda h: h & np.uint64(1))
    for seq in sequences():
        assert runs_of(np.array(seq, dtype=np.int32), Periodic()) == brute(seq), seq


def test_words_of_parts(monkeypatch):
    monkeypatch.setattr(periodic_runs, "PART_BYTES", 5)
    monkeypatch.setattr(periodic_runs, "PART_WORDS", 3)
    text = "ab  ñandú\tab\x0b\x0cwwwwwwwwwwww\x1cx\n日本 ab x y ab ".encode()
    ids, words = word_ids(text)
    assert [words[i] for i in ids] == text.split()
    assert collapsed(ids, words, []) == b" ".join(text.split())
    assert word_ids(b" \n") [0].tolist() == []


def test_long_text_is_scanned_in_little_time():
    """A million words of one kind, and a long period."""
    r = np.random.default_rng(1)
    for seq in (np.zeros(1_000_000, dtype=np.int32), np.tile(r.integers(0, 500, 40_000), 6).astype(np.int32)):
        began = time.time()
        assert [x[:2] for x in runs_of(seq, Periodic())] == [(0, len(seq))]
        assert time.time() - began < 120


def test_report(spark, corpus):
    r = random.Random(2)
    rows = corpus + [(1000 + i, " ".join(r.choice("abcdefgh") for _ in range(r.randint(1, 90)))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {x.doc_id: tuple(x) for x in run_report(with_cycles(docs)).collect()}
    assert got == {i: report(i, t) for i, t in rows}
    assert sum(x[1] for x in got.values()) > 20


def test_odd_rows(spark, odd_docs):
    got = sorted(map(tuple, run_report(with_cycles(odd_docs)).collect()), key=str)
    assert got == sorted((report(x[0], x[1]) for x in ODD), key=str)
    for f in (run_report, periodic_runs.periodic_runs, with_cycles):
        assert f(odd_docs.limit(0)).collect() == []
    assert cycled(b"", 10) == b"" and cycled(b"a  b", 11) == b"a  b"


def test_query_on_whole_table(spark):
    rows = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    got = {x.doc_id: tuple(x) for x in entries.op12_periodic_runs(spark, SF001).collect()}
    assert got == {x.doc_id: report(x.doc_id, x.text) for x in rows}
