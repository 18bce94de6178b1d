"""Registered queries of the training-data operators, one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import (
    conversations,
    embeddings,
    fingerprints,
    jaccard,
    mixing,
    negatives,
    packing,
    pages,
    permutations,
    pii,
    sharding,
    suffixes,
    toxicity,
)
from skyledger.llm.common import table


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.removed(table(spark, folder, "documents"))


def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.linked(table(spark, folder, "documents"))


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op4_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edits(table(spark, folder, "documents"))


def op5_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near(table(spark, folder, "embeddings"))


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    planned = mixing.plan(table(spark, folder, "documents"))
    return planned.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign(table(spark, folder, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.report(table(spark, folder, "documents"))
    return found.select(
        "doc_id", *[f"n_{kind}" for kind in pii.BASE], "base_sha256", "spans", *[f"n_{kind}" for kind in pii.ADDED]
    )


def op9_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract(table(spark, folder, "pages"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    chain = toxicity.fit(docs, labels, toxicity.CATEGORIES)
    flagged = toxicity.scored(docs.select("doc_id", "text"), chain)
    return flagged.select("doc_id", F.col("is_toxic").alias("toxic"), "p_toxic", "p_low_quality")


def op11_permutation_search(spark: SparkSession, folder: str) -> DataFrame:
    return permutations.nearest(table(spark, folder, "embeddings"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.mined(table(spark, folder, "embeddings"))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.report(table(spark, folder, "conversations"))


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_packing": op3_packing,
    "op4_document_fingerprints": op4_document_fingerprints,
    "op5_embedding_near_dedup": op5_embedding_near_dedup,
    "op6_mixing": op6_mixing,
    "op7_sharding": op7_sharding,
    "op8_pii": op8_pii,
    "op9_html_extraction": op9_html_extraction,
    "op10_toxicity": op10_toxicity,
    "op11_permutation_search": op11_permutation_search,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_conversation_repair": op13_conversation_repair,
}
