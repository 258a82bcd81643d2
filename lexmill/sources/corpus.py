"""Corpus scans with a read-through cache."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexmill import schemas
from lexmill.operators.corpus import articles
from lexmill.operators.ordering import leading_fraction
from lexmill.session import file_state, path_exists, publish_folder


def raw_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, id, url, title, text`` from the documents table, which has no titles."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select(
        "doc_id",
        F.col("doc_id").cast("string").alias("id"),
        F.lit(None).cast("string").alias("url"),
        F.concat_ws(":", "source", F.col("doc_id").cast("string")).alias("title"),
        "text",
    )


def source_manifest(raw: DataFrame, fraction: float) -> str:
    """What a cache was made of: the fraction, the plan, and path, size and time of every source file."""
    spark = raw.sparkSession
    files = sorted((f, *file_state(spark, f)) for f in raw.inputFiles())
    plan = None if files else raw.semanticHash()
    return json.dumps({"fraction": fraction, "columns": raw.columns, "files": files, "plan": plan})


def load_articles(raw: DataFrame, cache_path: str, fraction: float = 0.5) -> DataFrame:
    """Leading ``fraction`` of the dump as ``doc_id, title, content``, cached as parquet.

    Each manifest of sources and fraction has a cache of its own below ``cache_path``. It is written
    aside and renamed when it is whole, so a cache that is there is finished and of these sources;
    of two writers one wins, and both read the same.
    """
    spark = raw.sparkSession
    manifest = source_manifest(raw, fraction)
    path = f"{cache_path}/cache-{hashlib.sha256(manifest.encode()).hexdigest()[:32]}"
    if not path_exists(spark, path):
        aside = f"{cache_path}/.writing-{uuid.uuid4().hex}"
        articles(leading_fraction(raw, "doc_id", fraction)).write.parquet(aside)
        spark.createDataFrame([(manifest,)], "value string").coalesce(1).write.text(f"{aside}/_manifest")
        publish_folder(spark, aside, path)
    return spark.read.schema(schemas.ARTICLES).parquet(path)


def export_text(table: DataFrame, path: str, overwrite: bool = False) -> None:
    """Stripped articles as plain text, one line end after each, for line-based tools."""
    mode = "overwrite" if overwrite else "errorifexists"
    table.select(F.col("content").alias("value")).write.mode(mode).option("lineSep", "\n").text(path)


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).withColumnRenamed("value", "line")
