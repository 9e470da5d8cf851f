"""The corpus pipeline: documents, stage by stage, to token ids.

`STAGES` names the stages in order; each takes (spark, docs, sf_dir) and
returns the documents that go on, with the columns of `documents` (the last
adds the ids).  `run` writes each stage's result as Parquet in the shared
folder and reads it again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from runlens.llm import decontamination, ngram_join, quality, secret_scan, sentencepiece_codec
from runlens.llm.tables import read, written


NEAR = ngram_join.Similarity(n=5, percent=80)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality rules reject."""
    return quality.keep_good(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates: those that links
    of 5-word shingles with a Jaccard similarity of 0.8 or more reach."""
    return ngram_join.one_of_each(docs, NEAR)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that leak an item of the benchmark."""
    return decontamination.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by a mask; no document goes."""
    return secret_scan.mask_secrets(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds token ids and their number."""
    return sentencepiece_codec.with_ids(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("sentencepiece", sentencepiece),
]

# Neither merges of pieces nor near duplicates can be put in SQL; tests hold
# run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
