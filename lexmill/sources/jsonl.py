"""JSON-lines shards: one directory and one ordered file per shard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexmill import schemas
from lexmill.operators.ordering import row_index


def write_shards(sharded: DataFrame, path: str, n_shards: int, overwrite: bool = False) -> None:
    """Write ``title, content`` of table ``(shard, ord, doc_id, title, content)``.

    Shard i goes to task i, in shuffle order. An existing target is an error unless
    ``overwrite`` is given.
    """
    _write(sharded, path, n_shards, "overwrite" if overwrite else "errorifexists")


def append_files(sharded: DataFrame, path: str, n_shards: int) -> None:
    """One more file for each shard of the table, whose documents follow those of the files before."""
    _write(sharded, path, n_shards, "append")


def _write(sharded: DataFrame, path: str, n_shards: int, mode: str) -> None:
    (
        sharded.select("shard", "ord", "doc_id", "title", "content")
        .repartitionById(n_shards, F.col("shard"))
        .sortWithinPartitions("shard", "ord", "doc_id")
        .select("shard", "title", "content")
        .write.mode(mode)
        .partitionBy("shard")
        .json(path)
    )


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """``shard, title, content`` and the place ``file_name, byte_start, line`` in the file.

    A large file is read in several splits; the split offset and the running number of
    the row inside its split give the line order. The number also holds the task, so
    it is comparable inside one split only.
    """
    return (
        spark.read.schema(schemas.SHARD_LINES)
        .json(path)
        .select(
            "shard",
            "title",
            "content",
            F.col("_metadata.file_name").alias("file_name"),
            F.col("_metadata.file_block_start").alias("byte_start"),
            F.monotonically_increasing_id().alias("line"),
        )
    )


def number_lines(lines: DataFrame) -> DataFrame:
    """Add ``rnk``, the line number inside the shard, from zero."""
    return row_index(
        lines.withColumn("_piece", F.struct("file_name", "byte_start")),
        ["_piece", "line"],
        F.col("_piece"),
        within=["shard"],
        name="rnk",
    ).drop("_piece", "file_name", "byte_start", "line")
