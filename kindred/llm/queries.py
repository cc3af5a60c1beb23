"""Queries over the driver tables, one per operator, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import alignment, bpe, cap_filters, license_scan, line_dedup, mixing, prefix_trie, quality_rules, simhash, suffix_dedup, token_ids, toxicity, warc
from kindred.llm.sql import OP4, OP7, OP8, OP9, OP13

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_quality_rules")
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, likelihood-ratio score and verdict of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.quality_rules(docs, _table(spark, sf_dir, "labels"), prior=quality_rules.PRIOR).drop("text")


@query("op4_source_mix", OP4)
def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


@query("op8_line_dedup", OP8)
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the line chunks that come earlier elsewhere."""
    return line_dedup.line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op10_license_scan")
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence places, labels and score of every document."""
    return license_scan.license_scan(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@query("op3_token_ids")
def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids as read back from the shards written of the whole table."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    manifest = token_ids.write_token_ids(_table(spark, sf_dir, "documents"), vocabulary)
    return token_ids.read_token_ids(manifest, token_ids.id_width(vocabulary))


@query("op5_bpe")
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of their decoding."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.bpe_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


@query("op2_simhash")
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of near duplicates of every document."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


@query("op7_warc", OP7)
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record as read back from the archives, found by its URL in the capture index."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    _, index = warc.archive(pages)
    return warc.read_records(warc.lookup(index, pages))


@query("op6_cap_filters")
def op6_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of near duplicates of every vector."""
    return cap_filters.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


@query("op9_suffix_dedup", OP9)
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 200-byte strings that stand elsewhere too."""
    return suffix_dedup.suffix_dedup(_table(spark, sf_dir, "documents")).drop("spans")


@query("op11_alignment")
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of two tokenizers' tokens that end together, and the corpus counts of their links, per document."""
    docs = _table(spark, sf_dir, "documents")
    aligned = alignment.align_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    return aligned.withColumn("groups_sha256", digest).drop("groups")


@query("op12_toxicity")
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score and verdict of every document."""
    return toxicity.toxicity(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels"))


@query("op13_prefix_trie", OP13)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all conversations, rebuilt with borrowed heads."""
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))
