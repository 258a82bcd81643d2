"""Article tables: projection, stripping, lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lexmill.functions.text import lines, strip

MAX_LINE_BYTES = 16_384  # longer training lines are skipped


def articles(raw: DataFrame) -> DataFrame:
    """Raw dump columns ``id, url, title, text`` to ``doc_id, title, content``."""
    return raw.withColumnRenamed("text", "content").select("doc_id", "title", "content")


def records(table: DataFrame) -> DataFrame:
    """The two columns that a shard line holds."""
    return table.select("title", "content")


def stripped(table: DataFrame) -> DataFrame:
    return table.withColumn("content", strip(F.col("content")))


def training_lines(table: DataFrame) -> DataFrame:
    """One row per line of every article, numbered from zero."""
    return table.select("doc_id", F.posexplode(lines(F.col("content"))).alias("line_no", "line"))


def short_lines(line_table: DataFrame, max_bytes: int = MAX_LINE_BYTES) -> DataFrame:
    return line_table.where(F.octet_length("line") <= max_bytes)
