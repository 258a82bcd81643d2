"""A count-based next-token model: fit, evaluate, rank and draw candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

IGNORED = -1  # targets with this id do not count


def token_pairs(example_table: DataFrame, *keep: str) -> DataFrame:
    """One row per target: the current token ``x`` and the next one ``y``."""
    return example_table.select(*keep, F.inline(F.arrays_zip("x", "y"))).where(F.col("y") != IGNORED)


def split_counts(example_table: DataFrame) -> DataFrame:
    """``split, x, y, n``: how often y follows x in each split.

    Pairs are counted on the map side. Fit and evaluation need no more than this table,
    at most one row per split and pair of vocabulary ids.
    """
    return token_pairs(example_table, "split").groupBy("split", "x", "y").agg(
        F.count(F.lit(1)).alias("n")
    )


def next_model(counts: DataFrame, vocab_size: int, alpha: float = 1.0) -> DataFrame:
    """``x, y, n, total, p`` from pair counts ``x, y, n``, with add-alpha smoothing."""
    total = F.sum("n").over(Window.partitionBy("x"))
    return counts.select("x", "y", "n", total.alias("total")).withColumn(
        "p", (F.col("n") + alpha) / (F.col("total") + alpha * vocab_size)
    )


def score_pairs(pairs: DataFrame, model: DataFrame, vocab_size: int, alpha: float = 1.0) -> DataFrame:
    """Add ``nll``, the negative natural log of each pair's smoothed probability."""
    totals = model.select("x", "total").distinct()
    seen = model.select("x", "y", "p")
    unseen = F.lit(float(alpha)) / (F.coalesce("total", F.lit(0)) + alpha * vocab_size)
    return (
        pairs.join(seen, ["x", "y"], "left")
        .join(totals, "x", "left")
        .withColumn("nll", -F.ln(F.coalesce("p", unseen)))
        .drop("p", "total")
    )


def cross_entropy(
    counts: DataFrame, model: DataFrame, vocab_size: int, alpha: float = 1.0
) -> DataFrame:
    """``split, n_targets, loss`` from ``split_counts``: the mean over all targets."""
    scored = score_pairs(counts, model, vocab_size, alpha)
    return scored.groupBy("split").agg(
        F.sum("n").alias("n_targets"), (F.sum(F.col("n") * F.col("nll")) / F.sum("n")).alias("loss")
    )


def eval_by_split(
    batched_examples: DataFrame,
    model: DataFrame,
    vocab_size: int,
    eval_iters: int | None = 100,
    alpha: float = 1.0,
) -> DataFrame:
    """Mean over the first ``eval_iters`` batches (``None``: all) of each split of the batch mean loss.

    Batches of several loader workers are taken in turn, as a loader hands them out: the first
    batch of every worker, then the second ones.
    """
    key = ["split", "worker", "batch_id"]
    taken = batched_examples
    if "worker" not in taken.columns:
        taken = taken.withColumn("worker", F.lit(0))
    if eval_iters is not None:
        taken = taken.where(F.col("batch_id") < eval_iters)
        turn = F.row_number().over(Window.partitionBy("split").orderBy("batch_id", "worker"))
        first = taken.select(*key).distinct().withColumn("turn", turn)  # eval_iters rows for each worker
        taken = taken.join(first.where(F.col("turn") <= eval_iters).drop("turn"), key)
    counted = token_pairs(taken, *key).groupBy(*key, "x", "y").agg(F.count(F.lit(1)).alias("m"))
    per_batch = (
        score_pairs(counted, model, vocab_size, alpha)
        .groupBy(*key)
        .agg((F.sum(F.col("m") * F.col("nll")) / F.sum("m")).alias("batch_loss"))
    )
    return per_batch.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_batches"), F.avg("batch_loss").alias("loss")
    )


def top_k(model: DataFrame, k: int, score: str = "p") -> DataFrame:
    """Candidates per context whose score reaches the k-th best; ties there are kept."""
    rank = F.rank().over(Window.partitionBy("x").orderBy(F.desc(score)))
    return model.withColumn("rank", rank).where(F.col("rank") <= k)


def softmax(candidates: DataFrame, temperature: float = 1.0, score: Column | None = None) -> DataFrame:
    """Add ``prob``: scores over temperature, normalised inside each context.

    Candidates already removed count as probability 0. The default score is ln p.
    """
    scaled = (F.ln("p") if score is None else score) / F.lit(float(temperature))
    w = Window.partitionBy("x")
    return (
        candidates.withColumn("_s", scaled)
        .withColumn("_e", F.exp(F.col("_s") - F.max("_s").over(w)))
        .withColumn("prob", F.col("_e") / F.sum("_e").over(w))
        .drop("_s", "_e")
    )


def greedy(model: DataFrame) -> DataFrame:
    """The most probable next id per context; the smallest id wins a tie."""
    best = F.max(F.struct(F.col("p"), (-F.col("y")).alias("neg"))).alias("b")
    return model.groupBy("x").agg(best).select("x", (-F.col("b.neg")).alias("y"), F.col("b.p").alias("p"))


def draw(distribution: DataFrame, seed: int) -> DataFrame:
    """One seeded draw per context from ``prob``: first id whose running sum passes u."""
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("x").cast("string")))
    u = F.conv(F.substring(key, 1, 13), 16, 10).cast("bigint") / F.lit(float(16**13))
    w = Window.partitionBy("x").orderBy("y")
    cumulative = F.sum("prob").over(w.rowsBetween(Window.unboundedPreceding, 0))
    last = F.max("y").over(Window.partitionBy("x"))
    hit = (F.col("_cum") > F.col("u")) | (F.col("y") == F.col("_last"))
    return (
        distribution.withColumn("u", u)
        .withColumn("_cum", cumulative)
        .withColumn("_last", last)
        .where(hit)
        .groupBy("x")
        .agg(F.min("y").alias("y"), F.first("u").alias("u"))
    )
