"""From raw documents to packed training sequences.

Five stages, each working on all that its predecessor kept:

1. documents predicted toxic go;
2. of equal texts the row with the largest doc_id stays;
3. of each component of near copies the row with the smallest doc_id stays;
4. sources are mixed to their target weights: documents are left out or repeated;
5. what remains is packed into sequences.

All but the last return the columns of ``documents``.

Defined results: null texts count as empty and null ids are ids of their own, as
each operator says; a toxic score of one half is toxic; of repeated rows one
stays, and mixing may repeat it; very long texts go through whole and are cut by
the packing only; an empty table gives an empty result; other columns travel to
the packing, which leaves them out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from presslens.llm import exact_dedup, mixing, packing, simhash, toxicity
from presslens.llm.shared import materialise
from presslens.llm.tokens import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.survivors(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.survivors(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: SQL cannot express the class-conditional models, the tokenizer or the packing
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
