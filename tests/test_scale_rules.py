"""Rules that hold at any size: no hidden caps, spread work, defined edge cases."""

import pytest
from pyspark.sql import functions as F

from lexmill.operators import ordering, packing, runlog, vocab
from lexmill.plans import flows


def test_long_lines_reach_the_alphabet(spark):
    articles = spark.createDataFrame([(1, "t", "x" * 20_000 + "\u00e6")], "doc_id long, title string, content string")
    counted = vocab.word_counts(flows.lines_for_training(articles))
    assert "\u00e6" in counted.first()["word"]
    assert vocab.word_counts(flows.lines_for_training(articles, 16_384)).isEmpty()


def test_few_spans_are_enumerated_by_several_tasks(spark):
    lengths = spark.createDataFrame([(s, 3_000_000) for s in range(4)], "shard int, stream_len long")
    listed = packing.chunk_list(lengths, 4).groupBy(F.spark_partition_id()).count().collect()
    assert len(listed) >= 4 and sum(r["count"] for r in listed) == 4 * (3_000_000 // 4 - 1)


def test_half_of_an_odd_number_rounds_up(spark):
    assert ordering.leading_fraction(spark.range(5).withColumnRenamed("id", "k"), "k", 0.5).count() == 3


def test_average_of_nulls_and_constant_decay(spark):
    log = spark.createDataFrame([(0, s, float(v)) for s, v in enumerate((5, 6, 7))], "run int, step long, loss double")
    constant = runlog.running_average(log, decay=1.0, skip=0).orderBy("step").collect()
    assert [r["ema"] for r in constant] == [5.0, 5.0, 5.0]
    with pytest.raises(ValueError):
        runlog.running_average(log, decay=0.0)
    with pytest.raises(Exception, match="null"):
        runlog.running_average(log.withColumn("loss", F.expr("nullif(loss, 6D)")), skip=0).collect()
