"""One query for each operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm import decontamination, line_dedup, ngram_join, periodic_runs, quality, resampling, secret_scan, sentencepiece_codec, sharding, substring_dedup, suffix_dedup, token_counts, toxicity
from runlens.llm.tables import read

Query = Callable[[SparkSession, str], DataFrame]
SHARDS = 16


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text under piece_bpe_32k.model, and the round trip."""
    return sentencepiece_codec.encoded(read(spark, sf_dir, "documents"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the bytes of repeated 400-byte strings."""
    return suffix_dedup.suffix_dedup(read(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 90 % of their 3-word shingles."""
    return ngram_join.ngram_components(read(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0-15 of documents under the law `rows`."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = read(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return sharding.sharded(rows, SHARDS).withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(read(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated 35-word windows."""
    return substring_dedup.substring_dedup(read(spark, sf_dir, "documents"))


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(read(spark, sf_dir, "documents"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(document, item) pairs of documents that leak a benchmark item."""
    return decontamination.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("text_key")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, drawn by their likeness to the benchmark."""
    return resampling.resampling_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of the documents, some of which are put into cycles first."""
    return periodic_runs.run_report(periodic_runs.with_cycles(read(spark, sf_dir, "documents")))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten documents or more hold."""
    return line_dedup.line_report(read(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    found = [op1_sentencepiece, op2_suffix_array_dedup, op3_token_counts, op4_ngram_jaccard_join, op5_toxicity, op6_sharding, op7_quality_rules, op8_substring_dedup, op9_secret_scans, op10_benchmark_decontamination, op11_importance_resampling, op12_periodic_runs, op13_line_dedup]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op10_benchmark_decontamination": decontamination.duck_sql(), "op11_importance_resampling": resampling.duck_sql(), "op13_line_dedup": line_dedup.duck_sql()}
