"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from turnstile.llm import (decontaminate, jaccard_join, minhash_dedup, pii, quality_classifier, quality_rules, run_detection,
                           sentencepiece_codec, substring_dedup, suffix_dedup, url_filter, vector_codes, warc)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(_table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.digest(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(_table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(_table(spark, sf_dir, "pages"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digest(_table(spark, sf_dir, "documents"), model_path())


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.digest(_table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(_table(spark, sf_dir, "documents"))


def op11_run_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_detection.digest(_table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.digest(_table(spark, sf_dir, "embeddings"))


def op13_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.digest(_table(spark, sf_dir, "documents"))


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_substring_dedup, op2_url_filter, op3_suffix_dedup, op4_quality_classifier, op5_warc, op6_quality_rules,
    op7_decontaminate, op8_sentencepiece, op9_jaccard_join, op10_pii, op11_run_detection,
    op12_vector_codes, op13_minhash_dedup)}

ORACLES: dict[str, str] = {
    "op1_substring_dedup": substring_dedup.ORACLE, "op5_warc": warc.ORACLE, "op7_decontaminate": decontaminate.ORACLE,
    "op9_jaccard_join": jaccard_join.ORACLE, "op11_run_detection": run_detection.ORACLE, "op12_vector_codes": vector_codes.ORACLE,
    "op13_minhash_dedup": minhash_dedup.ORACLE}
