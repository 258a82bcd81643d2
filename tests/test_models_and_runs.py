import math
import random

import pytest
from pyspark.sql import functions as F

from lexmill.operators import nexttoken, runlog
from tests.plain import plain_ema


def examples(spark):
    rows = [("train", [1, 2, 1, 2], [2, 1, 2, 3]), ("val", [1, 3, 1], [2, 3, -1])]
    return spark.createDataFrame(rows, "split string, x array<int>, y array<int>")


def fitted(spark):
    counts = nexttoken.split_counts(examples(spark))
    return counts, nexttoken.next_model(counts.where("split = 'train'"), 4)


def test_model_and_cross_entropy(spark):
    counts, model = fitted(spark)
    p = {(r["x"], r["y"]): r["p"] for r in model.collect()}
    assert p == {(1, 2): 3 / 6, (2, 1): 2 / 6, (2, 3): 2 / 6}
    loss = {r["split"]: (r["n_targets"], r["loss"]) for r in nexttoken.cross_entropy(counts, model, 4).collect()}
    # The context 3 was never seen and the target -1 is ignored.
    assert loss["val"][0] == 2 and math.isclose(loss["val"][1], -(math.log(3 / 6) + math.log(1 / 4)) / 2)
    assert math.isclose(loss["train"][1], -(2 * math.log(3 / 6) + 2 * math.log(2 / 6)) / 4)


def test_eval_takes_the_mean_of_batch_means(spark):
    _, model = fitted(spark)
    batched = spark.createDataFrame(
        [("val", 0, [1], [2]), ("val", 1, [2, 2, 2], [1, 1, 2]), ("val", 2, [1], [1])],
        "split string, batch_id long, x array<int>, y array<int>",
    )
    r = nexttoken.eval_by_split(batched, model, 4, eval_iters=2).first()
    first = -math.log(3 / 6)
    second = -(2 * math.log(2 / 6) + math.log(1 / 6)) / 3
    assert r["n_batches"] == 2 and math.isclose(r["loss"], (first + second) / 2)
    third = -math.log(1 / 6)
    assert math.isclose(nexttoken.eval_by_split(batched, model, 4, None).first()["loss"], (first + second + third) / 3)
    # Two workers hand out their first batches before the second one of the first worker.
    shared = batched.withColumn("worker", F.expr("if(batch_id = 1, 1, 0)")).withColumn(
        "batch_id", F.expr("case batch_id when 2 then 1L else 0L end"))
    assert math.isclose(nexttoken.eval_by_split(shared, model, 4, 2).first()["loss"], (first + second) / 2)


def scores(spark, values):
    return spark.createDataFrame([(0, i, float(v)) for i, v in enumerate(values)], "x int, y int, p double")


def test_topk_keeps_ties_and_greedy_takes_the_smallest(spark):
    assert nexttoken.top_k(scores(spark, [3, 2, 2, 1]), 2).count() == 3
    assert nexttoken.top_k(scores(spark, [3, 2, 2, 1]), 99).count() == 4
    assert nexttoken.greedy(scores(spark, [1, 3, 3])).first()["y"] == 1


def test_softmax_and_draw(spark):
    dist = nexttoken.softmax(scores(spark, [1, 2, 4]), 0.5)
    got = [r["prob"] for r in dist.orderBy("y").collect()]
    want = [v * v for v in (1, 2, 4)]
    assert all(math.isclose(a, b / sum(want)) for a, b in zip(got, want))
    many = spark.range(4000).select(
        F.col("id").cast("int").alias("x"), F.inline(F.array(*[F.struct(F.lit(i).alias("y"), F.lit(p).alias("prob")) for i, p in enumerate((0.2, 0.0, 0.8))]))
    )
    drawn = nexttoken.draw(many, 5)
    share = {r["y"]: r["count"] / 4000 for r in drawn.groupBy("y").count().collect()}
    assert set(share) == {0, 2} and abs(share[0] - 0.2) < 0.03
    assert drawn.exceptAll(nexttoken.draw(many.repartition(13), 5)).isEmpty()


def log_of(spark, runs):
    rows = [(r, i, float(v)) for r, values in runs.items() for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "run long, step long, loss double")
    return df.withColumn("ts", F.timestamp_seconds(F.col("step") * F.col("step") * 1000))


def by_step(df, column, run=0):
    return [r[column] for r in df.where(F.col("run") == run).orderBy("step").collect()]


def test_best_so_far(spark):
    log = log_of(spark, {0: [5.0, 6, 4, 4, 3]})
    got = runlog.best_so_far(log, block_steps=2)
    assert by_step(got, "improved") == [True, False, True, False, True]
    assert by_step(got, "saved") == [False, False, True, False, True]
    assert by_step(runlog.every_kth(log, 2), "step") == [0, 2, 4]


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_blocks_do_not_change_results(spark, block):
    rng = random.Random(7)
    runs = {0: [rng.random() for _ in range(50)], 1: [rng.random() for _ in range(4)]}
    log = log_of(spark, runs).repartition(5)
    gaps = by_step(runlog.step_seconds(log, block), "seconds")
    assert gaps == [None] + [((i + 1) ** 2 - i**2) * 1000.0 for i in range(49)]
    best, want = 1e9, []
    for v in runs[0]:
        want.append(v < best)
        best = min(best, v)
    assert by_step(runlog.best_so_far(log, block), "improved") == want


@pytest.mark.parametrize("decay, longest", [(0.9, 65_536), (0.5, 65_536), (0.01, 65_536), (0.999999, 64), (0.999, 7), (0.9, 1)])
def test_running_average_over_many_blocks(spark, decay, longest, monkeypatch):
    """Slow decays over hundreds of blocks: what came before fades over many of them."""
    monkeypatch.setattr(runlog, "LONGEST_BLOCK", longest)
    rng = random.Random(3)
    runs = {0: [rng.uniform(-5, 5) for _ in range(6000)], 1: [1.0] * 5, 2: [10.0] * 5 + [10.0, 20, 20]}
    got = runlog.running_average(log_of(spark, runs).repartition(4), decay=decay)
    want = plain_ema(runs[0], decay, 5)
    assert all(math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9) for a, b in zip(by_step(got, "ema"), want))
    assert len(by_step(got, "ema")) == len(want) and by_step(got, "ema", 1) == []
    if decay == 0.9 and longest > 1:
        assert [round(v, 9) for v in by_step(got, "ema", 2)] == [10, 11, 11.9]


def test_numbering_of_a_heavy_run(spark):
    rows = [(i, (i * 37) % 1000, 1 if i % 3 else 2) for i in range(3000)]
    events = spark.createDataFrame(rows, "event_id long, m int, user_id long").select(
        "event_id", "user_id", F.timestamp_seconds(F.col("m") * 60).alias("ts"), F.lit(1.0).alias("value")
    )
    got = {}
    for r in runlog.from_events(events.repartition(7)).select("run", "step", "ts").collect():
        got.setdefault(r["run"], {})[r["step"]] = r["ts"]
    for run, steps in got.items():
        assert sorted(steps) == list(range(sum(1 for x in rows if x[2] == run)))
        assert [steps[i] for i in sorted(steps)] == sorted(steps.values())
