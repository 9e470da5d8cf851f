"""Substring and suffix-array dedup, and the n-gram join, by brute force."""

from __future__ import annotations

import hashlib
import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from runlens.llm import entries
from runlens.llm.components import components
from runlens.llm.ngram_join import Similarity, _in_outline, _linked, ngram_components, ngram_sets, one_of_each
from runlens.llm.substring_dedup import substring_dedup
from runlens.llm.suffix_dedup import COVER, PERIOD, suffix_dedup
from runlens.llm.tables import settled
from tests.conftest import SF001

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def without(items, length, join):
    key = (lambda x: x) if items and isinstance(items[0], bytes) else tuple
    seen = Counter(key(x[p : p + length]) for x in items for p in range(len(x) - length + 1))
    out = []
    for x in items:
        gone = [False] * len(x)
        for p in range(len(x) - length + 1):
            if seen[key(x[p : p + length])] > 1:
                gone[p : p + length] = [True] * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(x), sum(gone), spans, hashlib.sha256(join([v for v, g in zip(x, gone, strict=True) if not g])).hexdigest()))
    return out


def groups(texts, n, percent):
    """component of each text, by all pairs"""
    sets = []
    for t in texts:
        w = (t or "").encode().translate(LOWER).split()
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set()))
    own = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = sorted((own[i], own[j]))
                own = [x if o == y else o for o in own]
    return [len(s) for s in sets], own


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, "doc_id long, text string").repartition(4)


@pytest.mark.parametrize("hot", [4096, 2])
def test_substrings(docs, corpus, hot):
    want = without([t.encode().split() for _, t in corpus], 8, b" ".join)
    got = {r.doc_id: (r.n_words, r.n_removed, r.n_spans, r.kept_sha256) for r in substring_dedup(docs, 8, hot).collect()}
    assert [got[i] for i in range(len(corpus))] == want


@pytest.mark.parametrize("hot", [4096, 2])
def test_suffixes(docs, corpus, hot):
    want = without([t.encode() for _, t in corpus], 45, bytes)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup(docs, 45, hot).collect()}
    assert [got[i] for i in range(len(corpus))] == want


def test_cover_has_all_differences():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (2, 70), (1, 50)])
def test_ngram_components(docs, corpus, n, percent):
    sizes, own = groups([t for _, t in corpus], n, percent)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_components(docs, Similarity(n, percent)).collect()}
    assert [got[i] for i in range(len(corpus))] == list(zip(sizes, own, strict=True))
    blank = {i for i, s in enumerate(sizes) if not s}
    assert {r.doc_id for r in one_of_each(docs, Similarity(n, percent)).collect()} == set(own) | blank


def test_outlines_lose_no_link(spark):
    """Pairs on both sides of the threshold, some far below it."""
    r = random.Random(5)
    texts = []
    for _ in range(12):
        words = [f"w{r.randrange(3000)}" for _ in range(r.randint(40, 400))]
        texts.append(" ".join(words))
        for share in (0.01, 0.03, 0.06, 0.3):
            texts.append(" ".join(f"x{r.randrange(3000)}" if r.random() < share / 2 else w for w in words))
    like = Similarity(5, 80)
    sets = ngram_sets(pa.array(texts), like.n)
    pairs = [(a, b) for a in range(len(texts)) for b in range(a)]
    linked = {(a, b) for a, b in pairs if 100 * len(x := np.intersect1d(sets[a], sets[b])) >= 80 * (len(sets[a]) + len(sets[b]) - len(x))}
    assert 5 < len(linked) < 60
    of = spark.createDataFrame([(i, len(sets[i]), t) for i, t in enumerate(texts)], "class long, size long, text string")
    found = {(r.a, r.b) for r in _in_outline(spark.createDataFrame(pairs, "a long, b long"), of, like).collect()}
    assert linked <= found and len(found) < 2 * len(linked) + 10
    counted = _linked(spark.createDataFrame(sorted(found), "a long, b long"), of, like).where("linked").collect()
    assert {(r.a, r.b) for r in counted} == linked


def test_pairs_move_texts_and_steps_leave_no_shuffles(spark):
    """Texts have fewer bytes than hashes of their n-grams; shuffle files of a
    step go with it, though its plan is still held."""
    docs = spark.createDataFrame([(i, i, f"some words of text {i} and more of them") for i in range(50)], "class long, size long, text string")
    pairs = spark.createDataFrame([(i, i + 1) for i in range(49)], "a long, b long")
    step = _linked(pairs, docs.repartition(3, "class"), Similarity(2, 50))
    plan = step._jdf.queryExecution().optimizedPlan().toString()
    assert "text_a" in plan and "row_a" not in plan

    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("|").split("|")
        return {x for x in files if "/shuffle_" in x}

    before = shuffles()
    back = settled(step, "test-step")
    deadline = time.time() + 10
    while shuffles() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not shuffles() - before
    assert back.count() == 49


def test_components(spark):
    edges = [(5, 1), (2, 5), (7, 8), (8, 9), (9, 7), (3, 3), (20, 19), (19, 18), (18, 17), (17, 16), (16, 15)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {1: 1, 2: 1, 5: 1, 7: 7, 8: 7, 9: 7, **{i: 15 for i in range(15, 21)}}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_queries_on_whole_tables(spark):
    rows = spark.read.parquet(f"{SF001}/documents.parquet").orderBy("doc_id").collect()
    texts = [r.text for r in rows]
    for query, items, length, join, n in ((entries.op8_substring_dedup, [t.encode().split() for t in texts], 35, b" ".join, "n_words"), (entries.op2_suffix_array_dedup, [t.encode() for t in texts], 400, bytes, "n_bytes")):
        got = {r.doc_id: (r[n], r.n_removed, r.n_spans, r.kept_sha256) for r in query(spark, SF001).collect()}
        assert [got[r.doc_id] for r in rows] == without(items, length, join)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in entries.op4_ngram_jaccard_join(spark, SF001).collect()}
    assert [got[r.doc_id] for r in rows] == list(zip(*groups(texts, 3, 90), strict=True))
