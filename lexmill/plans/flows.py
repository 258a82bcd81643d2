"""The user-level flows, composed from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lexmill.operators import corpus, packing, shards, vocab
from lexmill.operators.bpe import encode_table
from lexmill.operators.bpe_train import MAX_PIECE, train_vocab
from lexmill.operators.chars import CharTokenizer
from lexmill.session import spread, write_table
from lexmill.sources.corpus import raw_articles
from lexmill.sources.jsonl import write_shards


def stripped_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(corpus.articles(raw_articles(spark, sf_dir)), "doc_id")
    return corpus.stripped(docs)


def char_tokenizer(articles: DataFrame) -> CharTokenizer:
    return CharTokenizer.from_vocab(vocab.character_vocab(articles, "content"))


def lines_for_training(articles: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """All lines; with ``max_bytes`` longer ones are left out."""
    lines = corpus.training_lines(articles)
    return lines if max_bytes is None else corpus.short_lines(lines, max_bytes)


def bpe_vocab(
    articles: DataFrame, vocab_size: int, max_bytes: int | None = None, sample: int | None = None,
    max_piece: int = MAX_PIECE,
) -> DataFrame:
    """Lines, word counts, merges: a vocabulary from whole articles.

    All lines count unless the caller sets a line limit or a number of sampled lines.
    """
    lines = lines_for_training(articles, max_bytes)
    if sample is not None:
        lines = vocab.sample_lines(lines, sample)
    return train_vocab(vocab.word_counts(lines), vocab_size, max_piece)


def prepare_shuffle(raw: DataFrame, path: str, n_shards: int = shards.DEFAULT_SHARDS,
                    seed: int = shards.DEFAULT_SEED, overwrite: bool = False) -> None:
    """Raw dump to shuffled JSON-lines shards; the articles are exchanged once."""
    placed = shards.assign_shards(corpus.articles(raw), n_shards, seed)
    write_shards(placed, path, n_shards, overwrite)


def token_table(articles: DataFrame, tokenizer, n_shards: int, seed: int = shards.DEFAULT_SEED) -> DataFrame:
    """``shard, ord, doc_id, n, tokens`` of stripped articles; moves no article."""
    return encode_table(shards.assign_shards(articles, n_shards, seed), tokenizer)


def stored_tokens(articles: DataFrame, tokenizer, n_shards: int) -> DataFrame:
    """The token table as a written table, for plans that read it more than once."""
    return write_table(token_table(articles, tokenizer, n_shards), "tokens")[0]


def example_table(tokens: DataFrame, context: int, n_shards: int) -> DataFrame:
    """``split, shard, chunk, x, y``."""
    streams = packing.document_offsets(tokens)
    table = packing.examples(packing.chunks(streams, context), context)
    return table.select(
        shards.split_of(F.col("shard"), n_shards).alias("split"), "shard", "chunk", "x", "y"
    )


def shard_files(tokens: DataFrame, n_shards: int, workers: int) -> DataFrame:
    """``split, worker, file_no, shard, stream_len`` for every shard, empty ones included."""
    all_shards = shards.shard_list(tokens.sparkSession, n_shards)
    placed = shards.worker_slices(shards.split_shards(all_shards), workers)
    files = placed.join(packing.stream_lengths(tokens, all_shards), "shard")
    # One row per shard, read several times: stored, so that tokens are counted once.
    return write_table(files.repartition(1), "files")[0]


def batch_table(files: DataFrame, context: int, batch_size: int, n_epochs: int) -> DataFrame:
    """``split, epoch, worker, batch_id, pos, shard, chunk`` from shard lengths alone."""
    listed = packing.chunk_list(files.drop("file_no"), context)
    ordered = shards.chunk_order(listed, n_epochs)
    return packing.batches(ordered, files, context, batch_size)


BROADCAST_EXAMPLES = 1_000_000


def leading_batches(
    tokens: DataFrame, files: DataFrame, context: int, batch_size: int, n_batches: int
) -> DataFrame:
    """``split, worker, batch_id, x, y`` of the first ``n_batches`` batches of every split and worker.

    Only the leading files of each worker are ordered and packed. Their examples are
    bounded by the parameters; only a small number is broadcast.
    """
    n = packing.chunk_count(F.col("stream_len"), context)
    w = Window.partitionBy("split", "worker").orderBy("file_no")
    before = F.coalesce(F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    leading = files.withColumn("_before", before).where(F.col("_before") < n_batches * batch_size)
    leading, _ = write_table(leading.drop("_before").repartition(1), "leading")
    numbered = batch_table(leading, context, batch_size, 1).where(F.col("batch_id") < n_batches)
    wanted = numbered.select("shard", "chunk", "batch_id")
    workers = files.select("split", "worker").distinct().count()
    if n_batches * batch_size * workers <= BROADCAST_EXAMPLES:
        wanted = F.broadcast(wanted)
    needed = leading.select("shard", "split", "worker")
    streams = packing.document_offsets(tokens.join(needed.select("shard"), "shard", "left_semi"))
    table = packing.examples(packing.chunks(streams, context), context)
    return table.join(wanted, ["shard", "chunk"]).join(needed, "shard").select(
        "split", "worker", "batch_id", "x", "y"
    )


def split_summary(articles: DataFrame, n_shards: int, context: int) -> DataFrame:
    """Documents, tokens, mean document length and examples per split."""
    tokens = token_table(articles, char_tokenizer(articles), n_shards).select("shard", "n")
    lengths = tokens.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n").cast("bigint").alias("stream_len")
    )
    return (
        lengths.groupBy(shards.split_of(F.col("shard"), n_shards).alias("split"))
        .agg(
            F.sum("n_docs").alias("n_docs"),
            F.sum("stream_len").alias("n_tokens"),
            F.sum(packing.chunk_count(F.col("stream_len"), context)).alias("n_examples"),
        )
        .withColumn("mean_len", F.round(F.col("n_tokens") / F.col("n_docs"), 6))
    )
