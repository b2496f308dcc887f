"""The corpus operators' queries, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import collocations, decontamination, language_id, mixing, near_duplicates, pii, prefix_trie, quality, repeated_passages, secrets, simhash, token_blocks, token_counts


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_blocks.token_blocks(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(read(spark, sf_dir, "documents"), size=2, percent=80)


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(read(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read(spark, sf_dir, "documents"))


def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages.repeated_passages(read(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_report(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(read(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(read(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read(spark, sf_dir, "conversations"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(read(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # it stands at the top of the repository and imports this module

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    operators = (
        op1_token_blocks, op2_decontamination, op3_near_duplicates, op4_personal_data, op5_mixing,
        op6_repeated_passages, op7_language_id, op8_secrets, op9_token_counts, op10_quality_rules,
        op11_prefix_trie, op12_simhash, op13_collocations, pipeline,
    )
    return {f.__name__: f for f in operators}
