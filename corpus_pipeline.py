"""A training corpus from raw documents: five stages, each over all that the one before kept."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from skyledger.llm import jaccard, mixing, packing, pii, toxicity
from skyledger.llm.common import cut, prepare, table


def toxic_out(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier chain does not reject."""
    prepare(spark)
    return toxicity.filtered(docs, table(spark, folder, "labels"))


def near_copies_out(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies: the one with the least id."""
    prepare(spark)
    return jaccard.deduplicated(docs)


def personal_data_out(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Personal data replaced by its kind in brackets; ``n_chars`` follows the text."""
    prepare(spark)
    return pii.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents repeated or left out so that sources have their target weights."""
    prepare(spark)
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of fixed-length token sequences; a document that is there twice is packed twice."""
    prepare(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxic_out),
    ("ngram_jaccard_join", near_copies_out),
    ("pii", personal_data_out),
    ("mixing", mixed),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each stage's rows are written before the next reads them."""
    documents = table(spark, sf_dir, "documents")
    *first, (_, last) = STAGES
    kept = reduce(lambda docs, stage: cut(stage[1](spark, docs, sf_dir)), first, documents)
    return last(spark, kept, sf_dir)


#: SQL has no trained classifier and no tokenizer; tests compare the stages with brute force.
ORACLE_SQL = None
