"""Incremental ingest of shard files.

``ingest`` takes files that are whole shards, so packing them needs no state from other batches.
``ingest_growing`` takes shards that come in several files and stores the open end of each stream. The
split is decided when the result is read, since it depends on the full shard list.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexmill import schemas
from lexmill.functions.text import strip
from lexmill.operators.ordering import running_offset
from lexmill.operators.packing import chunk_count, chunks, examples
from lexmill.session import drop_table, folder_names, path_exists, publish_files, publish_folder, remove_folder, write_table


def shard_stream(spark: SparkSession, folder: str, files_per_batch: int = 1) -> DataFrame:
    """Stream of ``shard, title, content`` with the place of each line in its file."""
    return (
        spark.readStream.schema(schemas.SHARD_LINES)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(folder)
        .select(
            "shard",
            "title",
            "content",
            F.struct(
                F.col("_metadata.file_name").alias("file"),
                F.col("_metadata.file_block_start").alias("byte"),
            ).alias("piece"),
        )
    )


def pack_files(lines: DataFrame, tokenizer, context: int) -> DataFrame:
    """``shard, chunk, x, y`` of complete shard files ``shard, piece, content``."""
    tokens = tokenizer.encode(strip(F.col("content")), bos=True, eos=True)
    encoded = lines.select("shard", "piece", tokens.alias("tokens")).select(
        "*", F.size("tokens").alias("n"), F.monotonically_increasing_id().alias("line")
    )
    # Written once: the line numbers then no longer depend on how the plan is run.
    stored, path = write_table(encoded, "batch")
    streams = running_offset(stored, ["piece", "line"], F.col("piece"), "n", within=["shard"])
    return examples(chunks(streams, context), context), path


def ingest(
    spark: SparkSession,
    folder: str,
    target: str,
    checkpoint: str,
    tokenizer,
    context: int,
    files_per_batch: int = 1,
):
    """Start the ingest; every batch owns the directory ``batch=<id>`` of the target.

    A batch that runs again after a failure replaces its own directory, so no example is
    written twice.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        packed, scratch = pack_files(batch, tokenizer, context)
        packed.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")
        drop_table(batch.sparkSession, scratch)

    return (
        shard_stream(spark, folder, files_per_batch)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


OPEN_ENDS = "shard int, chunk bigint, ids array<int>"


def pack_growing(lines: DataFrame, ends: DataFrame | None, tokenizer, context: int) -> tuple[DataFrame, DataFrame, str]:
    """What new files of growing shards complete: examples, and the shards' new open ends.

    An open end ``shard, chunk, ids`` is the next chunk's number and the tokens from its start on. It goes
    before the new lines as one more document. A chunk is final as soon as the stream holds its window
    and the next one, since only the last full window is dropped; so an end has fewer than two windows.
    """
    tokens = tokenizer.encode(strip(F.col("content")), bos=True, eos=True)
    encoded = lines.select("shard", "piece", F.monotonically_increasing_id().alias("line"), tokens.alias("tokens"))
    if ends is not None:
        before = F.struct(F.lit("").alias("file"), F.lit(-1).cast("bigint").alias("byte"))
        held = ends.select("shard", before.alias("piece"), F.lit(-1).cast("bigint").alias("line"), F.col("ids").alias("tokens"))
        encoded = encoded.unionByName(held)
    stored, path = write_table(encoded.withColumn("n", F.size("tokens")), "batch")
    streams = running_offset(stored, ["piece", "line"], F.col("piece"), "n", within=["shard"])
    # From where each stream goes on: one short row for each shard.
    first = F.lit(0).cast("bigint").alias("first")
    firsts = stored.select("shard").distinct().select("shard", first)
    if ends is not None:
        firsts = firsts.join(ends.select("shard", "chunk"), "shard", "left").select("shard", F.coalesce("chunk", "first").alias("first"))
    packed = examples(chunks(streams, context), context).join(F.broadcast(firsts), "shard")
    done = chunk_count(F.col("stream_len"), context)
    start = F.greatest(F.col("offset"), done * context)
    rest = F.slice("tokens", (start - F.col("offset") + 1).cast("int"), F.col("n"))
    parts = streams.where(F.col("offset") + F.col("n") > done * context).select(
        "shard", done.alias("done"), F.struct(start.alias("start"), rest.alias("ids")).alias("part")
    )
    open_ends = parts.groupBy("shard").agg(
        F.first("done").alias("done"), F.flatten(F.array_sort(F.collect_list("part"))["ids"]).alias("ids")
    )
    return (
        packed.select("shard", (F.col("first") + F.col("chunk")).alias("chunk"), "x", "y"),
        open_ends.join(F.broadcast(firsts), "shard").select("shard", (F.col("first") + F.col("done")).alias("chunk"), "ids"),
        path,
    )


def ingest_growing(
    spark: SparkSession, folder: str, target: str, checkpoint: str, tokenizer, context: int, files_per_batch: int = 1
):
    """Start the ingest of shards that grow by files; every batch owns the files ``batch-<id>-*`` of the target.

    Files continue their shard's stream in the order in which batches take them, and by name within
    a batch. Whatever the batches are, the rows are those of packing the whole shards at once. The open
    ends of all shards after a batch lie beside the checkpoint's files; a batch that runs again starts from
    those of the batch before it and replaces its own rows and ends. No task holds a shard.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        ends = session.read.schema(OPEN_ENDS).parquet(f"{checkpoint}/open_ends/{batch_id - 1}") if batch_id else None
        packed, open_ends, scratch = pack_growing(batch, ends, tokenizer, context)
        aside = f"{target}/_batch-{batch_id}"
        packed.write.mode("overwrite").parquet(aside)
        publish_files(session, aside, target, f"batch-{batch_id}-")
        open_ends.coalesce(1).write.mode("overwrite").parquet(f"{checkpoint}/open_ends/{batch_id}")
        drop_table(session, scratch)
        remove_folder(session, f"{checkpoint}/open_ends/{batch_id - 2}")

    return (
        shard_stream(spark, folder, files_per_batch)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def running_counts(
    spark: SparkSession, folder: str, target: str, checkpoint: str, tokenizer, files_per_batch: int = 1
):
    """Documents and tokens per shard so far, kept in the state store.

    Only shards that a batch changes leave the store: the batch writes their new rows to a folder of
    its own, which it replaces when it runs again. ``latest_counts`` takes each shard's newest row.
    """
    tokens = tokenizer.encode(strip(F.col("content")), bos=True, eos=True)
    counts = (
        shard_stream(spark, folder, files_per_batch)
        .select("shard", F.size(tokens).alias("n"))
        .groupBy("shard")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_tokens"))
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return (
        counts.writeStream.outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _finished(spark: SparkSession, target: str) -> tuple[int, list[str]]:
    """The last batch that is merged, or -1, and the folders that hold its and all later rows."""
    numbers: dict[str, list[int]] = {"merged": [], "batch": []}
    for name in folder_names(spark, target):
        kind, _, number = name.partition("=")
        if kind in numbers and path_exists(spark, f"{target}/{name}/_SUCCESS"):
            numbers[kind].append(int(number))
    merged = max(numbers["merged"], default=-1)
    later = [f"batch={k}" for k in sorted(numbers["batch"]) if k > merged]
    return merged, [f"merged={merged}"] * (merged >= 0) + later


def latest_counts(spark: SparkSession, target: str) -> DataFrame:
    """``shard, n_docs, n_tokens``: the newest row of every shard from the finished batches of ``running_counts``."""
    _, folders = _finished(spark, target)
    if not folders:
        raise FileNotFoundError(f"no complete result in {target}")
    rows = None
    for age, name in enumerate(folders):
        part = spark.read.parquet(f"{target}/{name}").select("shard", "n_docs", "n_tokens", F.lit(age).alias("age"))
        rows = part if rows is None else rows.unionByName(part)
    newest = F.max_by(F.struct("n_docs", "n_tokens"), "age").alias("newest")
    return rows.groupBy("shard").agg(newest).select("shard", "newest.*")


def merge_counts(spark: SparkSession, target: str) -> None:
    """Merge what the finished batches hold into one row per shard, so that reading stays short.

    The merged table gets its name by a rename, then the folders that it stands for go; stopped at any
    point, ``latest_counts`` is the same. A merged batch that runs again is not read.
    """
    merged, folders = _finished(spark, target)
    if not folders or folders[-1] == f"merged={merged}":
        return
    last = folders[-1].removeprefix("batch=")
    aside = f"{target}/.merging-{uuid.uuid4().hex}"
    latest_counts(spark, target).coalesce(1).write.parquet(aside)
    publish_folder(spark, aside, f"{target}/merged={last}")
    for name in folders:
        remove_folder(spark, f"{target}/{name}")
