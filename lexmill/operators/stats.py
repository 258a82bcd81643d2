"""Accounting of words, tokens, documents and shards; log-log fits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexmill.functions.text import word_count, words


def document_words(table: DataFrame) -> DataFrame:
    return table.select("doc_id", word_count(F.col("content")).cast("bigint").alias("n_words"))


def total_words(table: DataFrame) -> DataFrame:
    return table.agg(F.sum(word_count(F.col("content"))).cast("bigint").alias("n_words"))


def shard_stats(tokens: DataFrame, shards: DataFrame, bos_id: int = 1) -> DataFrame:
    """Tokens and mean document length per shard: tokens over begin markers.

    A shard without documents has 0 tokens and no mean.
    """
    starts = F.size(F.filter("tokens", lambda t: t == bos_id))
    sums = tokens.groupBy("shard").agg(
        F.sum("n").cast("bigint").alias("n_tokens"), F.sum(starts).cast("bigint").alias("n_starts")
    )
    return shards.join(sums, "shard", "left").select(
        "shard",
        F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"),
        F.try_divide(F.col("n_tokens"), F.col("n_starts")).alias("mean_len"),
    )


def corpus_totals(tokens: DataFrame, *by: str) -> DataFrame:
    """Documents and tokens for every level of the rollup ``by``; the last level is all."""
    return tokens.rollup(*by).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n").cast("bigint").alias("n_tokens")
    )


def shard_count(shards: DataFrame) -> DataFrame:
    return shards.agg(F.countDistinct("shard").alias("n_shards"))


def steps_plan(totals: DataFrame, context: int, batch_size: int, accumulation: int = 1) -> DataFrame:
    """Tokens per optimizer step, and batches needed to see every token once."""
    per_batch = batch_size * context
    return totals.select(
        "*",
        F.lit(accumulation * per_batch).cast("bigint").alias("tokens_per_step"),
        (F.col("n_tokens") / F.lit(per_batch)).alias("n_steps"),
    )


def vocabulary_growth(table: DataFrame, group: str) -> DataFrame:
    """``grp, x, y``: words and distinct words of every document; null without words."""
    w = words(F.col("content"))
    return table.select(F.col(group).alias("grp"), w.alias("w")).select(
        "grp",
        F.nullif(F.size("w"), F.lit(0)).cast("double").alias("x"),
        F.nullif(F.size(F.array_distinct("w")), F.lit(0)).cast("double").alias("y"),
    )


def loglog_fit(points: DataFrame) -> DataFrame:
    """Least squares ``log10 y = m log10 x + c`` per group, in one mergeable aggregate."""
    lx, ly = F.log10("x"), F.log10("y")
    return points.groupBy("grp").agg(
        F.regr_slope(ly, lx).alias("m"), F.regr_intercept(ly, lx).alias("c")
    )


def loglog_predict(m: Column, c: Column, x: Column | float) -> Column:
    x = x if isinstance(x, Column) else F.lit(float(x))
    return F.pow(F.lit(10.0), m * F.log10(x) + c)
