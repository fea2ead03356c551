"""The queries of this package, by name, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sportmart.llm import (
    conversation_repair, decontamination, embedding_dedup, language_id, license_scan, line_dedup, quality_rules,
    sentencepiece_bpe, sharding, simhash, spelling_variants, substring_dedup, token_counts,
)
from sportmart.llm.common import documents, importable
from sportmart.llm.oracles import ORACLE


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(documents(spark, sf_dir)).select("doc_id", "n_lines", "n_removed", "text")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    coded = sentencepiece_bpe.round_trip(public_tokenizers.path("piece_bpe_32k.model"))
    rows = documents(spark, sf_dir).select("doc_id", coded("text").alias("coded"))
    return rows.select("doc_id", *sentencepiece_bpe.digests(rows["coded"]))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.linked_documents(documents(spark, sf_dir))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identified(documents(spark, sf_dir))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.counted_documents(documents(spark, sf_dir), path, public_tokenizers.PATTERN)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_documents(documents(spark, sf_dir))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.documents_sharded(documents(spark, sf_dir))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digested(documents(spark, sf_dir))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return conversation_repair.repair(conversation_repair.damaged(turns))


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.deduplicated(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_decontamination, op3_line_dedup, op4_sentencepiece, op5_simhash, op6_language_id,
        op7_token_counts, op8_license_scan, op9_sharding, op10_substring_dedup,
        op11_conversation_repair, op12_embedding_dedup, op13_spelling_variants,
    )
}

__all__ = ["ORACLE", "QUERIES"]
