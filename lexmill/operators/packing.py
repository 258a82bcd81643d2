"""Token streams per shard, fixed-length chunks, next-token examples, batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexmill.functions.arith import div
from lexmill.operators.ordering import hash_block, running_offset
from lexmill.session import task_count

UINT16_MAX = 65_535
SPAN = 65_536  # chunk numbers produced per row when a stream is enumerated


def narrow_ids(ids: Column) -> Column:
    """The same array; a value outside uint16 stops the job."""
    bad = F.exists(ids, lambda i: (i < 0) | (i > UINT16_MAX))
    return F.when(bad, F.raise_error(F.lit("token id outside 0..65535"))).otherwise(ids)


def uint16_violations(tokens: DataFrame) -> DataFrame:
    """Number of ids per shard that do not fit uint16."""
    bad = F.size(F.filter("tokens", lambda i: (i < 0) | (i > UINT16_MAX)))
    return tokens.groupBy("shard").agg(F.sum(bad).cast("bigint").alias("n_bad"))


def document_offsets(tokens: DataFrame) -> DataFrame:
    """Add ``offset`` (tokens of the shard before this document) and ``stream_len``.

    Input ``shard, ord, doc_id, n`` and any other columns; order is ``ord, doc_id``.
    """
    return running_offset(
        tokens, ["ord", "doc_id"], hash_block(F.col("ord")), "n", within=["shard"], name="offset"
    )


def chunk_count(stream_len: Column, context: int) -> Column:
    """Chunks of a stream: all full windows but the last one."""
    return F.greatest(div(stream_len, context) - 1, F.lit(0))


def chunks(streams: DataFrame, context: int) -> DataFrame:
    """``shard, chunk, ids``: chunk i is tokens ``[i*C, i*C + C]`` of the shard's stream.

    Input ``shard, offset, stream_len, n, tokens``. Chunks inside one document are cut
    where the document is. Only the at most two chunks that cross its borders are
    exchanged, and a group never holds more than C + 1 tokens.
    """
    o, end = F.col("offset"), F.col("offset") + F.col("n")
    limit = chunk_count(F.col("stream_len"), context) - 1
    none = F.array().cast("array<bigint>")

    def piece(i: Column) -> Column:
        start = F.greatest(o, i * context)
        stop = F.least(end, i * context + context + 1)
        ids = F.slice("tokens", (start - o + 1).cast("int"), (stop - start).cast("int"))
        return F.struct(i.alias("chunk"), start.alias("start"), ids.alias("ids"))

    def pieces(numbers: Column) -> DataFrame:
        chosen = F.when(F.col("n") > 0, numbers).otherwise(none)
        return streams.select("shard", F.inline(F.transform(chosen, piece)))

    low = div(o + (context - 1), context)
    high = F.least(div(end - 1, context) - 1, limit)
    inner = pieces(F.when(low <= high, F.sequence(low, high)).otherwise(none))
    # The chunk that began in an earlier document, and the one that goes on in a later one.
    ends = F.array(F.when(o > 0, div(o - 1, context)), div(end - 1, context))
    border = pieces(F.filter(F.array_distinct(ends), lambda i: i <= limit))
    joined = (
        border.groupBy("shard", "chunk")
        .agg(F.array_sort(F.collect_list(F.struct("start", "ids"))).alias("p"))
        .select("shard", "chunk", F.flatten(F.col("p.ids")).alias("ids"))
    )
    return inner.select("shard", "chunk", "ids").unionByName(joined)


def examples(chunk_table: DataFrame, context: int) -> DataFrame:
    """``x`` is the chunk without its last token, ``y`` without its first."""
    rest = [c for c in chunk_table.columns if c != "ids"]
    return chunk_table.select(
        *rest, F.slice("ids", 1, context).alias("x"), F.slice("ids", 2, context).alias("y")
    )


def prefix_examples(chunk_table: DataFrame, context: int) -> DataFrame:
    """One row per position: the first i + 1 tokens of a chunk predict the next one."""
    rest = [c for c in chunk_table.columns if c != "ids"]
    steps = F.transform(
        F.sequence(F.lit(1), F.lit(context)),
        lambda i: F.struct(F.slice("ids", 1, i).alias("prefix"), F.get("ids", i).alias("target")),
    )
    return chunk_table.select(*rest, F.inline(steps))


def stream_lengths(tokens: DataFrame, shards: DataFrame) -> DataFrame:
    """``shard, stream_len`` for every shard of the list, empty ones included."""
    sums = tokens.groupBy("shard").agg(F.sum("n").cast("bigint").alias("stream_len"))
    return shards.join(sums, "shard", "left").withColumn(
        "stream_len", F.coalesce("stream_len", F.lit(0))
    )


def bad_shards(lengths: DataFrame, context: int, strict: bool = False) -> DataFrame:
    """Shards with fewer than two full windows; ``strict`` makes them an error."""
    bad = lengths.where(chunk_count(F.col("stream_len"), context) == 0)
    if strict:
        first = bad.orderBy("shard").first()
        if first:
            raise ValueError(f"shard {first['shard']} has {first['stream_len']} tokens: too small")
        if lengths.isEmpty():
            raise ValueError("there are no token shards")
    return bad


def chunk_list(lengths: DataFrame, context: int) -> DataFrame:
    """One row per chunk number, from the stream lengths alone.

    Two steps of bounded sequences, so one long stream is enumerated by many tasks.
    """
    rest = [c for c in lengths.columns if c != "stream_len"]
    n = chunk_count(F.col("stream_len"), context)
    spans = (
        lengths.select(*rest, n.alias("_n"))
        .where("_n > 0")
        .select(*rest, "_n", F.explode(F.sequence(F.lit(0), div(F.col("_n") - 1, SPAN))).alias("_s"))
    )
    if "shard" in rest:
        # An explicit number: adaptive execution would merge these few bytes into one task.
        spans = spans.repartition(task_count(spans.sparkSession), "shard", "_s")
    low = F.col("_s") * SPAN
    high = F.least(low + SPAN, F.col("_n")) - 1
    return spans.select(*rest, F.explode(F.sequence(low, high)).alias("chunk"))


def batches(ordered: DataFrame, lengths: DataFrame, context: int, batch_size: int) -> DataFrame:
    """Number the examples of each worker into batches.

    ``ordered`` is ``split, worker, epoch, shard, chunk, pos_in_shard``; ``lengths`` is
    ``split, worker, file_no, shard, stream_len``. A worker reads its files in order,
    epoch after epoch, so a batch may hold the end of one epoch and the start of the next.
    """
    w = Window.partitionBy("split", "worker")
    n = chunk_count(F.col("stream_len"), context)
    before = F.coalesce(
        F.sum(n).over(w.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    files = lengths.select(
        "split", "worker", "shard", before.alias("_before"), F.sum(n).over(w).alias("_per_epoch")
    )
    place = F.col("epoch") * F.col("_per_epoch") + F.col("_before") + F.col("pos_in_shard")
    return (
        ordered.join(files, ["split", "worker", "shard"])
        .withColumn("_place", place)
        .withColumn("batch_id", div(F.col("_place"), batch_size))
        .withColumn("pos", (F.col("_place") % batch_size).cast("int"))
        .drop("_place", "_before", "_per_epoch", "pos_in_shard")
    )


def collect_batches(batched: DataFrame, example_table: DataFrame) -> DataFrame:
    """One row per batch with its examples in order; a group holds one batch."""
    return (
        batched.join(example_table, ["shard", "chunk"])
        .groupBy("split", "worker", "batch_id")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "x", "y"))).alias("examples"))
    )
