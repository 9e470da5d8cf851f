"""Nulls, empty and long texts, repeated rows, empty tables, clashing names."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from runlens.llm import decontamination, ngram_join, quality, secret_scan, sentencepiece_codec, sharding, substring_dedup, suffix_dedup, token_counts, toxicity
from tests.llm.conftest import ODD

IDS = Counter(x[0] for x in ODD)


def labels(spark):
    return spark.createDataFrame([(1, 1), (2, 0), (3, 0), (5, 0), (None, 1), (6, None)], "doc_id long, toxic int")


def items(spark):
    return spark.createDataFrame([(1, "long words go on long words go on"), (2, None), (None, "x y"), (3, "")], "item_id long, text string")


OPERATORS = {
    "sentencepiece": lambda spark, docs: sentencepiece_codec.encoded(docs),
    "suffix": lambda spark, docs: suffix_dedup.suffix_dedup(docs),
    "tokens": lambda spark, docs: token_counts.token_counts(docs),
    "ngrams": lambda spark, docs: ngram_join.ngram_components(docs),
    "toxicity": lambda spark, docs: toxicity.toxicity(docs, labels(spark)),
    "shards": lambda spark, docs: sharding.sharded(docs.select("doc_id", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("crc")), 3),
    "quality": lambda spark, docs: quality.quality_report(docs),
    "substrings": lambda spark, docs: substring_dedup.substring_dedup(docs),
    "secrets": lambda spark, docs: secret_scan.secret_report(docs),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_each_row_has_a_result(spark, odd_docs, name):
    out = OPERATORS[name](spark, odd_docs)
    assert Counter(r["doc_id"] for r in out.collect()) == IDS
    assert "clash" not in {str(v) for r in out.collect() for v in r}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, odd_docs, name):
    empty = OPERATORS[name](spark, odd_docs.limit(0))
    assert empty.collect() == []


def test_null_and_blank_texts(spark, odd_docs):
    blank = {2, 3, 4}
    for r in substring_dedup.substring_dedup(odd_docs).collect():
        if r.doc_id in blank:
            assert (r.n_words, r.n_removed) == (0, 0)
        if r.doc_id == 7:
            assert r.n_words == r.n_removed == 16_000
    for r in ngram_join.ngram_components(odd_docs).collect():
        if r.doc_id in blank:
            assert (r.n_shingles, r.component_id) == (0, r.doc_id)
        if r.n_shingles == 4 and r.doc_id is None:
            assert r.component_id == 1  # the text of row 1
    kept = {r.doc_id: r.kept for r in quality.quality_report(odd_docs).collect()}
    assert not any(kept[i] for i in blank)


def test_filters_keep_all_columns(spark, odd_docs):
    good = quality.keep_good(odd_docs)
    assert good.columns == odd_docs.columns
    masked = secret_scan.mask_secrets(odd_docs)
    assert masked.columns == odd_docs.columns and masked.count() == len(ODD)
    once = ngram_join.one_of_each(odd_docs)
    assert once.columns == odd_docs.columns
    left = Counter(r.doc_id for r in once.collect())
    assert left[1] == 1 and left[None] == 2 and left[2] == left[3] == left[4] == 1
    clean = decontamination.without_leaks(odd_docs, items(spark))
    assert clean.columns == odd_docs.columns
    assert Counter(r.doc_id for r in clean.collect()) == IDS - Counter([7])
    assert decontamination.without_leaks(odd_docs, items(spark).limit(0)).count() == len(ODD)
    assert quality.keep_good(odd_docs.limit(0)).collect() == [] == ngram_join.one_of_each(odd_docs.limit(0)).collect()


def test_decontamination_of_odd_rows(spark, odd_docs):
    found = decontamination.leaks(odd_docs, items(spark)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(7, 1)}
    assert decontamination.leaks(odd_docs.limit(0), items(spark)).collect() == []
    shuffled = decontamination.leaks(odd_docs, items(spark), decontamination.Template(broadcast_rows=0)).collect()
    assert sorted(map(str, shuffled)) == sorted(map(str, found))
