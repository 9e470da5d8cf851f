"""The pipeline on odd rows, repeated rows, clashing names and an empty table."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from runlens.session import new_scratch
from tests.conftest import SF001
from tests.llm.conftest import CLASHES, ODD


def folder(spark, rows):
    path = new_scratch(spark, "odd-pipeline")
    names = ", ".join(f"`{c}` string" for c in CLASHES)
    docs = spark.createDataFrame([(*x, *["clash"] * len(CLASHES)) for x in rows], f"doc_id long, text string, lang string, n_chars long, {names}")
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, "long words go on long words go on"), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, docs.columns


def test_pipeline_on_odd_rows(spark):
    plain = [(r.doc_id, r.text, r.lang, r.n_chars) for r in spark.read.parquet(f"{SF001}/documents.parquet").orderBy("doc_id").limit(40).collect()]
    without_id = [(None, *x[1:]) for x in plain[30:]]
    path, columns = folder(spark, [*plain[:30], *without_id])
    once = corpus_pipeline.run(spark, path).collect()
    # rows that come again, and those without words, change nothing
    path, _ = folder(spark, [*plain[:30], *without_id, *plain[:7], *without_id[:3], *ODD])
    out = corpus_pipeline.run(spark, path)
    assert set(columns) <= set(out.columns)
    rows = out.collect()
    key = lambda r: (r.doc_id, r.text)
    assert Counter(map(key, rows)) == Counter(map(key, once)) and len(once) > 15
    assert any(r.doc_id is None for r in once)
    assert max(Counter(map(key, rows)).values()) == 1


def test_pipeline_on_no_rows(spark):
    path, _ = folder(spark, [])
    assert corpus_pipeline.run(spark, path).collect() == []
