"""From raw documents to token ids in five stages, each over all that the one before kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next one's documents.  All but the last return the columns of
documents.

Defined cases, as in the operators that the stages call: a NULL or empty text fails the quality
rules' least length and goes; rows without doc_id come last in every order; extra columns are kept
by all stages but the last; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kindred.llm import bpe, line_dedup, mixing, quality_rules, simhash
from kindred.session import cut_lineage

#: SQL can express neither the XXH64 hashes of the first and third stage nor the merges of the last.
ORACLE_SQL = None


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), prior=quality_rules.PRIOR)


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of repeated runs that stand earlier; those left without a word go.

    Repeated content-defined chunks go as in ``op8_line_dedup``; windows of two neighbouring lines and
    long lines carry the removal on to the edges of the repeated run.
    """
    return line_dedup.without_repeated_lines(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates."""
    return simhash.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the mix takes, one row per document and pass."""
    return mixing.mixed_texts(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, with their digest and that of their decoding."""
    return bpe.bpe_encode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", good_documents),
    ("line_dedup", fresh_lines),
    ("simhash_near_dedup", one_of_each),
    ("source_mix", mixed),
    ("bpe", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; the lineage is cut between them by written tables."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
