import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lexmill.functions.text import WHITESPACE, strip, word_count
from lexmill.operators import corpus, ordering, shards, vocab


def test_strip_and_words_follow_python(spark):
    cases = [c + "a b" + c for c in WHITESPACE] + ["​a﻿", "", "   ", "a　b c\n", "\x1ca"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string")
    for r in df.select("i", strip(F.col("t")).alias("s"), word_count(F.col("t")).alias("n")).collect():
        assert r["s"] == cases[r["i"]].strip()
        assert r["n"] == len(cases[r["i"]].split())


def test_lines_and_long_lines(spark):
    text = "a\n\nb\n" + "x" * 16384 + "\n" + "y" * 16385
    lines = corpus.training_lines(spark.createDataFrame([(1, text)], "doc_id long, content string"))
    assert [r["line"] for r in lines.orderBy("line_no").collect()][:3] == ["a", "", "b"]
    assert corpus.short_lines(lines).count() == 4


@pytest.mark.parametrize("n,k", [(10, 3), (3, 5), (12, 4), (1, 1), (101, 7)])
def test_balanced_parts(spark, n, k):
    df = spark.range(n).select(ordering.balanced_part(F.col("id"), F.lit(n).cast("bigint"), k).alias("p"))
    got = [r["p"] for r in df.collect()]
    q, e = divmod(n, k)
    want = [i for i in range(k) for _ in range(q + (i < e))]
    assert sorted(got) == want


def shuffled(n, k, seed):
    order = sorted(range(n), key=lambda i: hashlib.md5(f"{seed}:{i}".encode()).hexdigest())
    q, e = divmod(n, k)
    place, out = 0, {}
    for s in range(k):
        for _ in range(q + (s < e)):
            out[order[place]] = (s, place)
            place += 1
    return out


@pytest.mark.parametrize("parts", [1, 4, 13])
@pytest.mark.parametrize("k", [1, 7, 300])
def test_shuffle_is_the_same_on_every_partitioning(spark, parts, k):
    docs = spark.range(250).select(F.col("id").alias("doc_id")).repartition(parts)
    want = shuffled(250, k, 9)
    index = {r["doc_id"]: (r["shard"], r["rnk"]) for r in shards.shuffle_index(docs, k, 9).collect()}
    assert index == want
    placed = {r["doc_id"]: r["shard"] for r in shards.assign_shards(docs, k, 9).collect()}
    assert placed == {d: s for d, (s, _) in want.items()}


def test_val_split_by_name_order(spark):
    assert shards.val_shard_numbers(750) == [0, 1, 10, 100]
    table = shards.split_shards(shards.shard_list(spark, 750))
    val = {r["shard"] for r in table.where("split = 'val'").collect()}
    assert val == {0, 1, 10, 100}
    by_number = shards.shard_list(spark, 750).select("shard", shards.split_of(F.col("shard"), 750).alias("split"))
    assert by_number.exceptAll(table).isEmpty()
    assert shards.split_shards(shards.shard_list(spark, 4)).where("split = 'train'").isEmpty()


def test_worker_slices(spark):
    table = shards.split_shards(shards.shard_list(spark, 14))
    rows = shards.worker_slices(table, 3).where("split = 'train'").orderBy("file_no").collect()
    assert [r["worker"] for r in rows] == [0, 0, 0, 0, 1, 1, 1, 2, 2, 2]
    assert [str(r["shard"]) for r in rows] == sorted(str(r["shard"]) for r in rows)
    many = shards.worker_slices(table, 8).where("split = 'val'")
    assert {r["worker"] for r in many.collect()} == {0, 1, 2, 3}


def test_kth_smallest_and_leading_fraction(spark):
    rng = random.Random(1)
    values = [rng.randint(-(2**62), 2**62) for _ in range(200)] + list(range(50)) + [2**63 - 1, -(2**63)]
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(5)
    ordered = sorted(values)
    for k in (1, 2, 77, 200, len(values)):
        assert ordering.kth_smallest(df, "v", k, bins=16) == ordered[k - 1]
    assert ordering.kth_smallest(df, "v", 0) is None
    half = {r["v"] for r in ordering.leading_fraction(df, "v", 0.5).collect()}
    assert half == set(ordered[: round(len(values) * 0.5)])
    plan = ordering.leading_fraction(df, "v", 0.5)._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" not in plan and "Window" not in plan


@pytest.mark.parametrize("n", [0, 1, 40, 299, 300, 1000])
def test_line_sample_is_exact(spark, n):
    rows = [(d, i, f"line {d} {i}") for d in range(30) for i in range(10)]
    lines = spark.createDataFrame(rows, "doc_id long, line_no int, line string").repartition(4)
    key = lambda r: hashlib.md5(f"3:{r[0]}:{r[1]}".encode()).hexdigest()
    want = sorted(sorted(rows, key=key)[:n])
    assert sorted(tuple(r) for r in vocab.sample_lines(lines, n, 3).collect()) == want


def test_running_offset_with_one_heavy_group(spark):
    rows = [(0 if i % 3 else i % 5, f"{i:04x}", i, i % 7) for i in range(2000)]
    df = spark.createDataFrame(rows, "shard int, ord string, doc_id long, n int").repartition(6)
    got = ordering.running_offset(
        df, ["ord", "doc_id"], F.substring("ord", 1, 2), "n", within=["shard"], name="o", total="t"
    ).collect()
    total, seen = {}, {}
    for s, _, d, n in rows:
        seen[d] = total.get(s, 0)
        total[s] = total.get(s, 0) + n
    assert {r["doc_id"]: r["o"] for r in got} == seen
    assert all(r["t"] == total[r["shard"]] for r in got)


def test_chunk_order_is_a_permutation_per_epoch(spark):
    listed = spark.range(40).select(
        F.lit("train").alias("split"), F.lit(1).alias("worker"), F.lit(2).alias("shard"), F.col("id").alias("chunk")
    )
    rows = shards.chunk_order(listed, 2).collect()
    orders = []
    for e in (0, 1):
        mine = sorted((r for r in rows if r["epoch"] == e), key=lambda r: r["pos_in_shard"])
        assert [r["pos_in_shard"] for r in mine] == list(range(40))
        orders.append([r["chunk"] for r in mine])
        key = lambda c: hashlib.md5(f"43:{e}:2:{c}".encode()).hexdigest()  # noqa: E731,B023
        assert orders[-1] == sorted(range(40), key=key)
    assert orders[0] != orders[1]
