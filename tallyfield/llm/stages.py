"""Stages of the corpus pipeline; each works on all that its predecessor kept.

Every stage but the last returns the columns it was given. Rows without an id or text, repeated
rows and empty tables are treated as the operators' modules say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.llm import exact_dedup, language_id, minhash, packing, pii
from tallyfield.llm.common import ship, stored, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is in doubt go."""
    ship(spark)
    return language_id.accepted(docs, language_id.learn(docs.where(~language_id.held_out())))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the largest id stays."""
    ship(spark)
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates, taken together over all links, the one with the smallest id stays."""
    ship(spark)
    return minhash.drop_near(docs)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind; n_chars follows the new text."""
    ship(spark)
    clean = pii.masked(docs)
    if "n_chars" not in clean.columns:
        return clean
    kind = clean.schema["n_chars"].dataType
    size = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(kind))
    return clean.withColumn("n_chars", size)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, with their ids as little-endian 32-bit integers."""
    ship(spark)
    return packing.pack(docs, with_ids=True)


STAGES = [
    ("language id", known_language),
    ("exact dedup", exact_copies),
    ("near dedup", near_copies),
    ("personal data", private_data),
    ("packing", packed),
]

#: Classifier, bootstrap and tokenizer are beyond SQL; a brute-force version tests the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
