"""Corpus pipeline: quality rules, exact and near deduplication, source mixing, tokenisation.

Every stage takes ``(spark, docs, sf_dir)`` and returns a frame; it is written as
Parquet and read again as the next stage's ``docs``.  All but the last keep the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import bpe, exact_dedup, mixing, quality, simhash
from millrace.llm.common import read_cut, table, write_cut


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the base rule or the learned decision list rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (up to runs of white space) the row with the smallest id stays."""
    return exact_dedup.keep_first(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8) the smallest id stays."""
    return simhash.keep_one(docs, shingle=5, similarity=0.8)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix of sources takes them."""
    return mixing.mix(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and digests that show the round trip."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digest(docs, path, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_duplicates),
    ("simhash_near_dedup", near_duplicates),
    ("source_mixing", source_mix),
    ("byte_bpe", tokenise),
]

#: The learned decision list and the tokeniser have no SQL form; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        docs = read_cut(spark, write_cut(out, name), out)
    return STAGES[-1][1](spark, docs, sf_dir)
