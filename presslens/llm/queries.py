"""Registered queries: one per operator, and the corpus pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from presslens.llm import alignment, chat, exact_dedup, mixing, packing, passage_dedup, sharding, simhash, suffix_dedup, token_files, topk_search, toxicity, whitening
from presslens.llm.tokens import vocabulary

SHARDS = 16
VOCABULARY = vocabulary("word_bpe_49k.json")
ALIGNED = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
FILE_END = 2


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.copies(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(_table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), VOCABULARY, packing.END_ID)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read(token_files.write(_table(spark, sf_dir, "documents"), VOCABULARY, FILE_END))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(chat.PROBE).alias("text"),
    )
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.formatted(given.unionByName(probe)))


def op7_kd_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree, grown = sharding.even_tree(SHARDS), sharding.even_tree(SHARDS + 1)
    placed = sharding.shards(_table(spark, sf_dir, "documents"), tree, grown)
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_copies(_table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("bits"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.copies(_table(spark, sf_dir, "documents"))


def op11_recompression_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_dedup.digest(_table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_table(spark, sf_dir, "documents"), *ALIGNED)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_source_mixing": op1_source_mixing,
        "op2_suffix_array_dedup": op2_suffix_array_dedup,
        "op3_best_fit_packing": op3_best_fit_packing,
        "op4_toxicity": op4_toxicity,
        "op5_token_files": op5_token_files,
        "op6_chat_formatting": op6_chat_formatting,
        "op7_kd_tree_top_k": op7_kd_tree_top_k,
        "op8_hash_tree_sharding": op8_hash_tree_sharding,
        "op9_simhash_near_dedup": op9_simhash_near_dedup,
        "op10_exact_dedup": op10_exact_dedup,
        "op11_recompression_dedup": op11_recompression_dedup,
        "op12_embedding_whitening": op12_embedding_whitening,
        "op13_cross_tokenizer_alignment": op13_cross_tokenizer_alignment,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    found = {
        "op1_source_mixing": mixing.ORACLE,
        "op6_chat_formatting": chat.ORACLE,
        "op7_kd_tree_top_k": topk_search.ORACLE,
        "op10_exact_dedup": exact_dedup.ORACLE,
        "op11_recompression_dedup": passage_dedup.ORACLE,
    }
    if corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
