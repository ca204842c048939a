"""The corpus pipeline: quality rules, language, near-duplicates, benchmark passages, token ids.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns what stays,
with the columns of documents; the last one returns the encoded documents. Every stage is written as
Parquet and read again as the next one's documents, so a lost executor repeats one stage's tasks at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tablesync.llm import byte_bpe, decontaminate, language, minhash, quality_rules
from tablesync.llm.base import settled, table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs, "text", "lang")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known from text, declaration and source."""
    return language.keep_known(docs, "doc_id", "text", "lang", "source")


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest id, of each group of near-duplicates."""
    return minhash.one_of_each(docs, "doc_id", "text")


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, "text", table(spark, sf_dir, "benchmark"), "item_id", "text")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, and digests of the ids and of the decoded bytes, per document."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(docs, "doc_id", "text", ranks, public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", good), ("language", known_language), ("near-duplicates", distinct), ("benchmark passages", clean), ("token ids", encode),
]

#: Four of the stages have no SQL form; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
