"""Exact duplicates: group by a 128-bit content hash, keep one stable id, compare bytes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexmill.llm.common import text_or_empty
from lexmill.session import write_table

#: Ways one group's texts are dealt for the byte comparison, so that a large group meets in no task.
SALTS = 16


def content_hash(text: Column) -> Column:
    """The 16 bytes of the MD5 sum."""
    return F.unhex(F.md5(text))


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "min",
    hash_of: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per input row: ``id_col, keep_id, group_size, kept, text_sha256``.

    Rows with identical texts are one group of ``group_size`` rows; ``keep_id`` is its smallest id
    (``keep="max"``: largest) and ``kept`` marks the one row that stays. Groups are found by the
    content hash; then the bytes of the texts inside each group are compared, and a group whose
    texts differ is split by its bytes.

    Only hashes and ids are grouped and joined; texts move once, for the comparison, and there
    each group is dealt over ``SALTS`` tasks and summed up before it meets. A null text is the
    empty text. Null ids are never preferred: a group with only null ids has a null ``keep_id``.
    Of repeated rows (same id and text) exactly one is kept. No rows give no rows. Other columns
    are not read, so their names do not matter.
    """
    best = {"min": F.min, "max": F.max}[keep]
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("body")).select(
        "id", "body", hash_of(F.col("body")).alias("h")
    )
    narrow, _ = write_table(
        texts.select("id", "h", F.unhex(F.sha2("body", 256)).alias("sha")), "exact-hashes"
    )
    groups = narrow.groupBy("h").agg(F.count(F.lit(1)).alias("n"), best("id").alias("keep_id"))
    several = groups.where("n > 1").select(
        "h", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    compared = (
        texts.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
        .join(several, ["h", "salt"], "left_semi")
        .groupBy("h", "salt")
        .agg(F.min("body").alias("low"), F.max("body").alias("high"))
        .groupBy("h")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
    )
    collided, _ = write_table(compared.where("low <> high").select("h"), "exact-collisions")
    rows = narrow.groupBy("h", "id").agg(
        F.count(F.lit(1)).alias("copies"), F.first("sha").alias("sha")
    )
    found = rows.join(groups, "h").select("id", "sha", "copies", "n", "keep_id")
    if not collided.isEmpty():  # two texts of one hash: their groups are made of the bytes themselves
        bad = texts.join(collided, "h", "left_semi").groupBy("body", "id").agg(
            F.count(F.lit(1)).alias("copies")
        )
        parts = bad.groupBy("body").agg(F.sum("copies").alias("n"), best("id").alias("keep_id"))
        split = bad.join(parts, "body").select(
            "id", F.unhex(F.sha2("body", 256)).alias("sha"), "copies", "n", "keep_id"
        )
        clean = rows.join(collided, "h", "left_anti").join(groups, "h")
        found = clean.select("id", "sha", "copies", "n", "keep_id").unionByName(split)
    copy = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")
    return found.select("*", copy).select(
        F.col("id").alias(id_col),
        "keep_id",
        F.col("n").alias("group_size"),
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min"
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Cases are settled as in ``exact_duplicates``; of repeated rows an arbitrary one stays, as
    they differ at most in columns that are not compared.
    """
    found, _ = write_table(exact_duplicates(docs, id_col, text_col, keep), "exact-groups")
    keys = [F.col(id_col).alias("__id"), F.col("text_sha256").alias("__kept_sha")]
    marked = docs.withColumn("__sha", F.sha2(text_or_empty(text_col), 256))
    stay = marked.join(
        found.where("kept").select(*keys),
        F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__sha") == F.col("__kept_sha")),
        "left_semi",
    )
    repeated = found.where(~F.col("kept") & F.col(id_col).eqNullSafe(F.col("keep_id")))
    if not repeated.isEmpty():
        again = Window.partitionBy(id_col, "__sha").orderBy("__sha")
        stay = stay.withColumn("__row", F.row_number().over(again)).where("__row = 1")
    return stay.select(*[F.col(f"`{c}`") for c in docs.columns])
