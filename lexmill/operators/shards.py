"""Seeded shuffle into balanced shards, train/validation split, worker slices, epochs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lexmill.operators.ordering import balanced_part, hash_block, hash_key, row_index

DEFAULT_SHARDS = 750
DEFAULT_SEED = 678
VAL_SHARDS = 4
LOADER_SEED = 42
RANK_STRIDE = 1337


def shuffle_index(table: DataFrame, n_shards: int = DEFAULT_SHARDS, seed: int = DEFAULT_SEED) -> DataFrame:
    """``doc_id, shard, rnk``: the place of every document in the seeded permutation."""
    keyed = table.select("doc_id", hash_key(seed, "doc_id").alias("ord"))
    ranked = row_index(keyed, ["ord", "doc_id"], hash_block(F.col("ord")), name="rnk", total="n_docs")
    return ranked.select(
        "doc_id", balanced_part(F.col("rnk"), F.col("n_docs"), n_shards).alias("shard"), "rnk"
    )


def assign_shards(table: DataFrame, n_shards: int = DEFAULT_SHARDS, seed: int = DEFAULT_SEED) -> DataFrame:
    """Add ``shard`` and the order key ``ord`` to the articles without moving them.

    Shards are contiguous ranges of the hash order. Only document keys are ranked; what
    comes back per hash block is its first shard and the keys where a new shard
    begins. That table has at most 65,536 rows plus ``n_shards`` keys and is broadcast.
    """
    keyed = table.withColumn("ord", hash_key(seed, "doc_id"))
    ranked = row_index(
        keyed.select("doc_id", "ord"),
        ["ord", "doc_id"],
        hash_block(F.col("ord")),
        name="rnk",
        total="n_docs",
        keep_block=True,
    )
    shard = balanced_part(F.col("rnk"), F.col("n_docs"), n_shards)
    before = balanced_part(F.col("rnk") - 1, F.col("n_docs"), n_shards)
    opens_shard = (F.col("rnk") > 0) & (shard != before)
    blocks = ranked.groupBy("_block").agg(
        F.min("rnk").alias("_start"),
        F.max("n_docs").alias("_n"),
        F.collect_list(F.when(opens_shard, F.struct("ord", "doc_id"))).alias("_cuts"),
    )
    table_of_blocks = blocks.select(
        "_block",
        F.when(F.col("_start") == 0, F.lit(0))
        .otherwise(balanced_part(F.col("_start") - 1, F.col("_n"), n_shards))
        .alias("_first"),
        "_cuts",
    )
    me = F.struct("ord", "doc_id")
    passed = F.size(F.filter("_cuts", lambda c: c <= me))
    return (
        keyed.withColumn("_block", hash_block(F.col("ord")))
        .join(F.broadcast(table_of_blocks), "_block")
        .withColumn("shard", (F.col("_first") + passed).cast("int"))
        .drop("_block", "_first", "_cuts")
    )


def shard_list(spark: SparkSession, n_shards: int) -> DataFrame:
    """All shard numbers, empty shards included."""
    return spark.range(n_shards).select(F.col("id").cast("int").alias("shard"))


def val_shard_numbers(n_shards: int, val_shards: int = VAL_SHARDS) -> list[int]:
    """Shards of the validation split: the first ones by file name, so by *string* order."""
    return sorted(range(n_shards), key=str)[:val_shards]


def split_of(shard: Column, n_shards: int, val_shards: int = VAL_SHARDS) -> Column:
    """Split name as a constant predicate on the shard number: prunes partitions."""
    in_val = shard.isin(val_shard_numbers(n_shards, val_shards))
    return F.when(in_val, F.lit("val")).otherwise(F.lit("train"))


def split_shards(shards: DataFrame, val_shards: int = VAL_SHARDS) -> DataFrame:
    """``shard, split`` from a table with one row per existing shard file."""
    w = Window.partitionBy(F.lit(0)).orderBy(F.col("shard").cast("string"))
    rank = F.row_number().over(w)
    return shards.select(
        "shard", F.when(rank <= val_shards, F.lit("val")).otherwise(F.lit("train")).alias("split")
    )


def worker_slices(split_table: DataFrame, num_workers: int) -> DataFrame:
    """``split, shard, worker, file_no``: contiguous balanced slices of each split's files.

    With more workers than files the surplus workers get no rows.
    """
    w = Window.partitionBy("split")
    n = F.count(F.lit(1)).over(w)
    file_no = F.row_number().over(w.orderBy(F.col("shard").cast("string"))) - 1
    return split_table.select("split", "shard", file_no.alias("file_no"), n.alias("_n")).select(
        "split",
        "shard",
        balanced_part(F.col("file_no").cast("bigint"), F.col("_n"), max(num_workers, 1)).alias("worker"),
        "file_no",
    )


def repeat_epochs(table: DataFrame, n_epochs: int) -> DataFrame:
    """Every row once per epoch."""
    return table.select(F.explode(F.sequence(F.lit(0), F.lit(n_epochs - 1))).alias("epoch"), "*")


def chunk_order(chunks: DataFrame, n_epochs: int = 1, seed: int = LOADER_SEED, rank: int = 0) -> DataFrame:
    """Seeded order of the chunks of each shard in each epoch.

    Input ``split, worker, shard, chunk``; adds ``epoch`` and ``pos_in_shard``. The
    seed is ``seed + worker + 1337 * rank``, as one generator per worker.
    """
    base = F.col("worker") + F.lit(seed + RANK_STRIDE * rank)
    keyed = repeat_epochs(chunks, n_epochs).withColumn(
        "_key", hash_key(base, "epoch", "shard", "chunk")
    )
    return row_index(
        keyed,
        ["_key", "chunk"],
        hash_block(F.col("_key"), 2),
        within=["split", "epoch", "shard"],
        name="pos_in_shard",
    ).drop("_key")
