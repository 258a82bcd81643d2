"""Total orders without one-task windows.

A row index or a running sum over a large ordered table is computed per *block*:
a column that never decreases along the order cuts every group into blocks, block
totals become a small table of starting values, and each block is then numbered on
its own. Work spreads over blocks, so one group may hold any share of the rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexmill.functions.arith import div

KEY_DIGITS = 4  # 65,536 blocks of a hash order


def hash_key(seed: int | str | Column, *parts: Column | str) -> Column:
    """Seeded order key: md5 of ``seed:part:part``, the same on every partitioning."""
    seed = seed if isinstance(seed, Column) else F.lit(str(seed))
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws(":", seed.cast("string"), *[c.cast("string") for c in cols]))


def hash_block(key: Column, digits: int = KEY_DIGITS) -> Column:
    return F.substring(key, 1, digits)


def _starts(sums: DataFrame, within: Sequence[str], start: str, total: str) -> DataFrame:
    # One row per block. Without ``within`` the caller's blocks are bounded in number.
    over = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    before = over.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(
        *within,
        "_block",
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias(start),
        F.sum("_sum").over(over).alias(total),
    )


def block_starts(
    df: DataFrame,
    block: Column,
    within: Sequence[str] = (),
    value: Column | None = None,
    start: str = "_start",
    total: str = "_total",
) -> DataFrame:
    """Per block: the sum of ``value`` before it, and the sum of its whole group."""
    value = F.lit(1) if value is None else value
    sums = (
        df.select(*within, block.alias("_block"), value.cast("bigint").alias("_value"))
        .groupBy(*within, "_block")
        .agg(F.sum("_value").alias("_sum"))
    )
    return _starts(sums, within, start, total)


def _attach(local: DataFrame, starts: DataFrame, within: Sequence[str]) -> DataFrame:
    # Only the un-grouped form has a fixed number of blocks, so only it is broadcast.
    return local.join(starts if within else F.broadcast(starts), [*within, "_block"])


def row_index(
    df: DataFrame,
    order: Sequence[str],
    block: Column,
    within: Sequence[str] = (),
    name: str = "idx",
    total: str | None = None,
    keep_block: bool = False,
) -> DataFrame:
    """Zero-based position in ``order`` inside each group, and the group size.

    ``block`` must be non-decreasing along ``order``; ``order`` must be total.
    Without ``within`` it must also have a bounded number of values. ``keep_block``
    leaves the block in column ``_block``; the result is partitioned by it.
    """
    size = total or "_total"
    starts = block_starts(df, block, within, start="_start", total=size)
    w = Window.partitionBy(*within, "_block").orderBy(*order)
    local = df.withColumn("_block", block).withColumn("_local", F.row_number().over(w) - 1)
    out = _attach(local, starts, within).withColumn(name, F.col("_start") + F.col("_local"))
    gone = ["_local", "_start"] + ([] if total else ["_total"]) + ([] if keep_block else ["_block"])
    return out.drop(*gone)


def running_offset(
    df: DataFrame,
    order: Sequence[str],
    block: Column,
    value: str,
    within: Sequence[str] = (),
    name: str = "offset",
    total: str = "stream_len",
) -> DataFrame:
    """Sum of ``value`` over all earlier rows of the group, and over the whole group."""
    starts = block_starts(df, block, within, F.col(value), start="_start", total=total)
    w = (
        Window.partitionBy(*within, "_block")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = df.withColumn("_block", block).withColumn(
        "_local", F.coalesce(F.sum(F.col(value).cast("bigint")).over(w), F.lit(0))
    )
    out = _attach(local, starts, within).withColumn(name, F.col("_start") + F.col("_local"))
    return out.drop("_block", "_local", "_start")


def balanced_part(idx: Column, n: Column, parts: int) -> Column:
    """Which of ``parts`` contiguous, balanced parts holds position ``idx`` of ``n``.

    The first ``n % parts`` parts hold one row more than the others.
    """
    parts_ = F.lit(parts).cast("bigint")
    size = div(n, parts_)
    extra = n % parts_
    head = extra * (size + 1)
    in_head = idx < head
    width = F.greatest(F.when(in_head, size + 1).otherwise(size), F.lit(1))
    base = F.when(in_head, F.lit(0)).otherwise(extra)
    past = idx - F.when(in_head, F.lit(0)).otherwise(head)
    return (base + div(past, width)).cast("int")


def kth_smallest(df: DataFrame, column: str, k: int, bins: int = 1024) -> int | None:
    """Exact k-th smallest (from 1) value of a bigint column, by narrowing histograms.

    Each pass is one map-side aggregation that returns at most ``bins`` + 1 rows, and
    the range shrinks by ``bins`` every time: at most seven passes for 64-bit values.
    """
    lo, hi, n = df.agg(F.min(column), F.max(column), F.count(column)).first()
    if not n or k < 1 or k > n:
        return None
    while lo < hi:
        width = -(-(hi - lo + 1) // bins)
        cell = F.expr(f"cast((cast(`{column}` as decimal(20,0)) - {lo}) div {width} as bigint)")
        counts = (
            df.where(F.col(column).between(lo, hi)).groupBy(cell.alias("cell")).count().collect()
        )
        for c, m in sorted((r["cell"], r["count"]) for r in counts):
            if k <= m:
                lo, hi = lo + c * width, min(hi, lo + (c + 1) * width - 1)
                break
            k -= m
    return lo


def leading_fraction(df: DataFrame, column: str, fraction: float) -> DataFrame:
    """The first ``floor(n * fraction + 0.5)`` rows by a unique bigint column.

    The result is a plain range filter, so it reaches the scan and moves no row.
    """
    k = math.floor(df.count() * fraction + 0.5)
    last = kth_smallest(df, column, k) if k else None
    return df.where(F.lit(False)) if last is None else df.where(F.col(column) <= F.lit(last))


def smallest_keys(df: DataFrame, key: str, tie: Sequence[str], n: int) -> DataFrame:
    """The ``n`` rows with the smallest hash key, exactly.

    Blocks that lie wholly below the cut pass by a filter; only the one block that
    holds the cut is ranked.
    """
    block = hash_block(F.col(key))
    counts = block_starts(df, block)
    cut = counts.where(F.col("_start") < n).agg(
        F.max(F.struct("_block", "_start")).alias("last")
    )
    marked = df.select(
        "*",
        block.alias("_block"),
        cut.select("last._block").scalar().alias("_cut"),
        cut.select("last._start").scalar().alias("_before"),
    )
    gone = ["_block", "_cut", "_before"]
    below = marked.where(F.col("_block") < F.col("_cut")).drop(*gone)
    w = Window.partitionBy("_block").orderBy(key, *tie)
    at_cut = (
        marked.where(F.col("_block") == F.col("_cut"))
        .withColumn("_rank", F.row_number().over(w))
        .where(F.col("_before") + F.col("_rank") <= n)
        .drop(*gone, "_rank")
    )
    return below.unionByName(at_cut)
