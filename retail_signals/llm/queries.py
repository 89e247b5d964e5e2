"""The registered queries: each applies one operator, with production settings,
to the whole of its table."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (binary_output, bpe, certified_packing, fingerprint, hard_negatives, ngram_join, packing, pii, quality,
               secret_scan, sharding, spelling, token_count)
from .common import stage, text_of
from .sql import ORACLE_SQL  # noqa: F401  (the entry module reads it from here)

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
PATTERN = public_tokenizers.PATTERN
SHARDS = 16
TOKEN_LIMIT = 4096


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards, _ = stage(sharding.shuffle_to_shards(documents(spark, sf_dir), SHARDS))
    return shards.select("doc_id", sharding.document_size(F.col("text")).alias("size"),
                         F.crc32(text_of()).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op2_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(secret_scan.scan_documents(documents(spark, sf_dir)))


def op3_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(documents(spark, sf_dir), RANKS, PATTERN)


def op4_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), RANKS, PATTERN, JSON, with_ids=False)


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_documents(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op6_scaled_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_digests(documents(spark, sf_dir))


def op7_resync_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (token_count.count_tokens(documents(spark, sf_dir), PIECES)
            .withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT))


def op8_best_fit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary_output.packed_rows(documents(spark, sf_dir), RANKS, PATTERN, JSON)


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan_documents(documents(spark, sf_dir))


def op10_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_documents(documents(spark, sf_dir))


def op11_certified_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = certified_packing.pack_certified(documents(spark, sf_dir), RANKS, PATTERN, JSON)
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id",
                         "offset", "certified")


def op12_chunk_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(documents(spark, sf_dir))


def op13_residue_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
                           .otherwise(F.col("label")))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_hypergeometric_shards, op2_secret_ownership, op3_tree_bpe, op4_sum_of_squares_packing,
        op5_ngram_jaccard, op6_scaled_fingerprints, op7_resync_token_counts, op8_best_fit_rows,
        op9_personal_data, op10_quality_cascade, op11_certified_packing, op12_chunk_variants,
        op13_residue_negatives)
}
