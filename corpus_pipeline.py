"""From documents to token ids: the corpus operators one after another, each stage written and read again.

Every stage takes nulls in any column, repeated rows and ids, very long texts, columns of any further name and
empty tables; the first four keep the columns of their input, and an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chartloom.llm import decontamination, mixing, near_duplicates, quality, token_blocks
from chartloom.llm.common import Stash
from chartloom.llm.queries import read, tokenizer_path


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: lines that fail go, documents that lose too much go. Null and empty texts have too few words and go;
    equal rows are judged alike."""
    return quality.clean(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, a similarity of 0.8) one document stays, the one with
    the least ``doc_id``; of equal rows one stays, and rows without an id stay if none of their group has one."""
    return near_duplicates.drop_near_duplicates(docs, size=5, percent=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go. Null and empty items match nothing; rows without text stay."""
    return decontamination.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out by the target of their source; a null source is one of its own, the last."""
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in chunks; per document what the files hold of it. A null text is an empty one: its
    end id only."""
    return token_blocks.token_blocks(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", clean_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("token_blocks", write_tokens),
]

#: The stages on hashes, edit distances and token ids are not for SQL; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    stash = Stash(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = stash.keep(stage(spark, docs, sf_dir), f"{k}-{name}")
        if k:
            stash.drop(f"{k - 1}-{STAGES[k - 1][0]}")
    return docs
