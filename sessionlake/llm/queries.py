"""Registered queries of this package: one per operator, each over its whole
table, and the DuckDB statement of the expected rows where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sessionlake.llm import exact_dedup, jaccard_join, language_id, license_scan, line_dedup, mixing, pii, piece_bpe, quality_rules, secret_scan, token_align, url_filter, whitening
from sessionlake.llm.common import documents


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(documents(spark, sf_dir))


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest(documents(spark, sf_dir))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.digest(documents(spark, sf_dir))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(documents(spark, sf_dir))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(documents(spark, sf_dir))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.digest(documents(spark, sf_dir))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(documents(spark, sf_dir))


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(documents(spark, sf_dir))


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    """Where a public vocabulary file lies on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.digest(documents(spark, sf_dir), tokenizer_path())


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op13_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.alignment(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), tokenizer_path())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_line_dedup, op2_license_scans, op3_ngram_jaccard, op4_exact_dedup, op5_quality_rules, op6_mixing, op7_language_id, op8_pii,
                                    op9_secret_scans, op10_sentencepiece, op11_whitening, op12_url_filter, op13_token_align)}


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": line_dedup.SQL, "op3_ngram_jaccard": jaccard_join.SQL, "op4_exact_dedup": exact_dedup.SQL,
            "op5_quality_rules": quality_rules.SQL}
