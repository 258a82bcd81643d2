"""Vocabulary files: one ``piece<TAB>score`` line per id, in id order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexmill import schemas
from lexmill.operators.bpe_train import FIRST_MERGE_ID, MAX_VOCAB, SPECIALS


def write_vocab(vocab: DataFrame, path: str, overwrite: bool = False) -> None:
    """One ordered file; a vocabulary has at most 65,536 rows."""
    if vocab.limit(MAX_VOCAB + 1).count() > MAX_VOCAB:
        raise ValueError("a vocabulary holds at most 65536 pieces")
    line = F.concat_ws("\t", "piece", F.col("score").cast("bigint").cast("string"))
    (
        vocab.repartitionById(1, F.lit(0))
        .sortWithinPartitions("id")
        .select(line.alias("value"))
        .write.mode("overwrite" if overwrite else "errorifexists")
        .text(path)
    )


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """``id, piece, score, kind``; the id is the line number.

    Lines split at ``\\n`` only and nothing is quoted, since pieces hold quote characters.
    """
    lines = (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_name").alias("file"),
            F.col("_metadata.file_block_start").alias("byte"),
            F.monotonically_increasing_id().alias("line"),
            "value",
        )
        .limit(MAX_VOCAB + 1)
        .collect()
    )
    if len(lines) > MAX_VOCAB:
        raise ValueError("a vocabulary holds at most 65536 pieces")
    rows = []
    for i, r in enumerate(sorted(lines)):
        piece, score = r["value"].rsplit("\t", 1)
        rows.append((i, piece, float(score)))
    table = spark.createDataFrame(rows, "id int, piece string, score double")
    kind = (
        F.when(F.col("id") < len(SPECIALS), "special")
        .when(F.col("id") < FIRST_MERGE_ID, "byte")
        .when(F.char_length("piece") == 1, "char")
        .otherwise("merge")
    )
    return table.withColumn("kind", kind).select(*schemas.VOCAB.names)
