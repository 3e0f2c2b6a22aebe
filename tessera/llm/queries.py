"""The opN queries: each applies its operator, with production parameters, to the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, fingerprints, language, licenses, mixing, near_dedup, oracles, quality, substring_dedup, suffix_dedup, token_counts
from .common import table

#: Where the public tokenizers' vocabulary files are. They are read by the driver and broadcast.
TOKENIZERS = "/opt/tokenizers"


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = token_counts.Vocabulary.from_ranks(f"{TOKENIZERS}/byte_bpe_50k.tiktoken")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.classify(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.fit(docs.where(~language.held_out(docs) & docs["doc_id"].isNotNull())))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_suffix_array_dedup": op1_suffix_array_dedup,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_license_scan": op5_license_scan,
    "op6_fingerprints": op6_fingerprints,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_language_id": op8_language_id,
    "op9_mix_sources": op9_mix_sources,
    "op10_decontaminate": op10_decontaminate,
}

ORACLES = {
    "op1_suffix_array_dedup": oracles.BYTES,
    "op2_minhash_near_dedup": oracles.GROUPS,
    "op7_substring_dedup": oracles.WORDS,
    "op9_mix_sources": mixing.SQL,
}
