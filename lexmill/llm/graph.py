"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lexmill.session import drop_table, write_table


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges ``(a, b)``, ``a > b``: neighbours of a node move to its smallest one.

    The large step looks at all neighbours and moves the larger ones; the small step looks at the
    smaller ones and moves them and the node itself.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        moved = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return moved.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``(a, b)`` of integers; root is the smallest.

    The number of steps follows the logarithm of a component's size. Each step is a written table,
    so lineage stays short; edges of a node with many neighbours are joined, never gathered.
    Loops and repeated edges do no harm; without edges there are no rows.
    """
    spark = edges.sparkSession
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    now, path = write_table(ordered, "edges")
    mark = None
    while True:
        after, new_path = write_table(_star(_star(now, True), False), "edges")
        row = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        drop_table(spark, path)
        now, path = after, new_path
        if tuple(row) == mark:
            break
        mark = tuple(row)
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
