"""Analytics over run logs ``run, step, ts, split, loss``.

Steps of a run are consecutive from 0, so ``step div B`` cuts a run of any length
into blocks of at most B rows; what crosses a block border travels in one row per block.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexmill.functions.arith import div
from lexmill.operators.ordering import row_index
from lexmill.session import drop_table, write_table

BLOCK_STEPS = 65_536
LONGEST_BLOCK = 65_536  # steps of a running average that one task takes
START_BEST = 1e9
SETTLE_STEPS = 5
DECAY = 0.9


def from_events(events: DataFrame, block_unit: str = "hour") -> DataFrame:
    """Run log from an event table: run = user, steps in time order from 0."""
    rows = events.select(
        F.col("user_id").alias("run"),
        "ts",
        "event_id",
        F.lit("val").alias("split"),
        F.col("value").alias("loss"),
    )
    block = F.date_trunc(block_unit, F.col("ts"))
    numbered = row_index(rows, ["ts", "event_id"], block, within=["run"], name="step")
    return numbered.select("run", "step", "ts", "split", "loss")


def every_kth(log: DataFrame, k: int) -> DataFrame:
    return log.where(F.col("step") % k == 0)


def _blocked(log: DataFrame, steps: int) -> DataFrame:
    return log.withColumn("_block", div(F.col("step"), steps))


def step_seconds(log: DataFrame, block_steps: int = BLOCK_STEPS) -> DataFrame:
    """Add ``seconds`` since the previous step of the run; null at the first step."""
    rows = _blocked(log, block_steps)
    ends = rows.groupBy("run", (F.col("_block") + 1).alias("_block")).agg(
        F.max_by("ts", "step").alias("_carry")
    )
    w = Window.partitionBy("run", "_block").orderBy("step")
    lagged = rows.withColumn("_prev", F.lag("ts").over(w)).join(ends, ["run", "_block"], "left")
    gap = F.col("ts") - F.coalesce("_prev", "_carry")
    return lagged.withColumn("seconds", _in_seconds(gap)).drop("_prev", "_carry", "_block")


def _in_seconds(gap: Column) -> Column:
    parts = {"DAY": 86_400, "HOUR": 3_600, "MINUTE": 60, "SECOND": 1}
    terms = [F.extract(F.lit(u), gap).cast("double") * s for u, s in parts.items()]
    return terms[0] + terms[1] + terms[2] + terms[3]


def best_so_far(log: DataFrame, block_steps: int = BLOCK_STEPS, start: float = START_BEST) -> DataFrame:
    """Add ``improved`` (strictly below every earlier value) and ``saved`` (not at step 0)."""
    rows = _blocked(log, block_steps)
    by_run = Window.partitionBy("run").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        rows.groupBy("run", "_block")
        .agg(F.min("loss").alias("_min"))
        .select("run", "_block", F.min("_min").over(by_run).alias("_carry"))
    )
    w = (
        Window.partitionBy("run", "_block")
        .orderBy("step")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    best = F.least(F.lit(start), F.coalesce("_own", F.lit(start)), F.coalesce("_carry", F.lit(start)))
    return (
        rows.withColumn("_own", F.min("loss").over(w))
        .join(carry, ["run", "_block"])
        .withColumn("improved", F.col("loss") < best)
        .withColumn("saved", F.col("improved") & (F.col("step") > 0))
        .drop("_own", "_carry", "_block")
    )


def scanned_blocks(ends: DataFrame, factor: float) -> DataFrame:
    """``run, _block, _sum`` with the sums of all blocks of the run up to this one, faded to its end.

    A block turns what comes before it into ``factor * before + sum``; two such steps make one of the
    same kind, so each round joins every block to the one as far behind as was combined so far,
    and the number of rounds is the logarithm of the number of blocks. Blocks without rows only fade.
    """
    last = ends.groupBy("run").agg(F.max("_block").alias("_last"))
    every = last.select("run", "_last", F.explode(F.sequence(F.lit(0), F.col("_last"))).alias("_block"))
    now, path = write_table(
        every.join(ends, ["run", "_block"], "left").select(
            "run", "_block", F.coalesce("_sum", F.lit(0.0)).alias("_sum"), F.lit(factor).alias("_factor")
        ),
        "block-ends",
    )
    blocks = (now.agg(F.max("_block")).first()[0] or 0) + 1
    behind = 1
    while behind < blocks:
        earlier = now.select(
            "run", (F.col("_block") + behind).alias("_block"), F.col("_sum").alias("_s"), F.col("_factor").alias("_f")
        )
        after, new_path = write_table(
            now.join(earlier, ["run", "_block"], "left").select(
                "run", "_block",
                (F.col("_sum") + F.col("_factor") * F.coalesce("_s", F.lit(0.0))).alias("_sum"),
                (F.col("_factor") * F.coalesce("_f", F.lit(1.0))).alias("_factor"),
            ),
            "block-ends",
        )
        drop_table(now.sparkSession, path)
        now, path, behind = after, new_path, 2 * behind
    return now.drop("_factor")


def running_average(
    log: DataFrame, value: str = "loss", decay: float = DECAY, skip: int = SETTLE_STEPS
) -> DataFrame:
    """Add ``ema``: the first kept value as it is, then ``decay * r + (1 - decay) * v``.

    The first ``skip`` steps are left out. Inside a block the recurrence is a running sum
    of values weighted by ``decay ** -i``; a block is short enough that this fits a double and that no
    task holds more than ``LONGEST_BLOCK`` steps. What crosses a block is the pair (factor, sum) of the
    blocks before it, combined by an associative scan, exact for any decay and number of blocks. A null
    value is an error; with a decay of 1 the first value stays.
    """
    if not 0 < decay <= 1:
        raise ValueError("decay must be above 0 and at most 1")
    missing = F.raise_error(F.lit("a value of the run log is null"))
    log = log.withColumn(value, F.when(F.col(value).isNull(), missing).otherwise(F.col(value)))
    if decay == 1:  # the first kept value stays
        first = F.first(value).over(Window.partitionBy("run").orderBy("step"))
        return log.where(F.col("step") >= skip).withColumn("ema", first)
    length = min(LONGEST_BLOCK, max(1, math.floor(100 * math.log(10) / -math.log(decay))))
    place = F.col("step") - skip
    rows = (
        log.where(F.col("step") >= skip)
        .withColumn("_block", div(place, length))
        .withColumn("_i", (place % length).cast("double"))
    )
    weight = F.when(place == 0, F.lit(1.0)).otherwise(F.lit(1.0 - decay))
    w = (
        Window.partitionBy("run", "_block")
        .orderBy("step")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    grown: Column = F.sum(weight * F.col(value) * F.pow(F.lit(decay), -F.col("_i"))).over(w)
    local = rows.withColumn("_local", grown * F.pow(F.lit(decay), F.col("_i")))
    term = weight * F.col(value) * F.pow(F.lit(decay), F.lit(length - 1.0) - F.col("_i"))
    ends = rows.groupBy("run", "_block").agg(F.sum(term).alias("_sum"))
    carry = scanned_blocks(ends, decay**length).select("run", (F.col("_block") + 1).alias("_block"), F.col("_sum").alias("_carry"))
    faded = F.coalesce("_carry", F.lit(0.0)) * F.pow(F.lit(decay), F.col("_i") + 1)
    return (
        local.join(carry, ["run", "_block"], "left")
        .withColumn("ema", F.col("_local") + faded)
        .drop("_local", "_carry", "_block", "_i")
    )
