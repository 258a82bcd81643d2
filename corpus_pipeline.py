"""The corpus pipeline: documents become training sequences, in five stages.

Quality rules drop junk, exact and near copies leave one document each, personal data is replaced
by its kind, and the remaining texts are packed. Each stage takes and returns whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexmill.llm import exact_dedup, jaccard_join, packing, private_data, quality
from lexmill.session import write_table

POLICY = "v1"
MAX_TOKENS = 2048


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the policy keeps."""
    return quality.keep_documents(docs, POLICY)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact_dedup.drop_exact_duplicates(docs, keep="max")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar texts."""
    return jaccard_join.drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without personal data; ``n_chars`` follows the text."""
    clean = private_data.redact_documents(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    return packing.pack_documents(docs, max_tokens=MAX_TOKENS)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("PII", personal_data),
    ("packing", sequences),
]
# Similarity classes, the random field and the tokenizer are beyond SQL; the tests hold the stages
# against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs, _ = write_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
