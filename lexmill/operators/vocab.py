"""Character sets, alphabet frequencies, training words, line samples."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lexmill.functions.text import characters, code_points
from lexmill.operators.ordering import hash_key, smallest_keys

MAX_SAMPLE_LINES = 20_000_000
FIRST_CHAR_ID = 3
CHAR_SPECIALS = {"<s>": 0, "</s>": 1, "<unk>": 2}

PAIR_WINDOW = 64
HELD_WORDS = 200_000  # distinct words that a task adds up before they leave it
WORD_START = "▁"
# Characters that never enter the byte-pair alphabet: control characters and white
# space other than U+0020. They split words and are encoded as bytes.
EXCLUDED_CLASS = (
    r"\x00-\x1f\x7f-\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
DIGIT_CLASS = "0-9"


def distinct_characters(texts: DataFrame, column: str) -> DataFrame:
    """Every character that occurs; each task marks the code points of its texts and sends them once."""
    schema = pa.schema([("ch", pa.string())])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0x110000, bool)
        for batch in batches:
            for points in code_points(batch.column(0)):
                seen[points] = True
        yield pa.RecordBatch.from_arrays([pa.array([chr(c) for c in np.flatnonzero(seen)], pa.string())], schema=schema)

    return texts.select(F.make_valid_utf8(F.col(column)).alias("text")).mapInArrow(found, "ch string").distinct()


def character_vocab(texts: DataFrame, column: str) -> DataFrame:
    """``ch, id``: sorted distinct characters from id 3, after the three special pieces.

    Ranking happens on the distinct characters only, at most one row per code point.
    """
    ranked = distinct_characters(texts, column).select(
        "ch",
        (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("ch")) + FIRST_CHAR_ID - 1)
        .cast("int")
        .alias("id"),
    )
    spark = texts.sparkSession
    return spark.createDataFrame(list(CHAR_SPECIALS.items()), "ch string, id int").unionByName(ranked)


def character_counts(texts: DataFrame, column: str) -> DataFrame:
    return (
        texts.select(F.explode(characters(F.col(column))).alias("ch"))
        .groupBy("ch")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def covered_alphabet(counts: DataFrame, coverage: float = 1.0) -> DataFrame:
    """``rank, ch, n``, most frequent first; below full coverage the rare tail is cut.

    A character stays while the share of the characters before it is below ``coverage``.
    """
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("n"), "ch")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return (
        counts.select(
            (F.row_number().over(order) - 1).alias("rank"), "ch", "n", before.alias("_b"), total.alias("_t")
        )
        .where(F.col("_b") < F.col("_t") * F.lit(coverage))
        .drop("_b", "_t")
    )


def sample_lines(lines: DataFrame, n: int = MAX_SAMPLE_LINES, seed: int = 0) -> DataFrame:
    """Uniform seeded sample of at most ``n`` training lines; a smaller table stays whole."""
    keyed = lines.withColumn("_key", hash_key(seed, "doc_id", "line_no"))
    return smallest_keys(keyed, "_key", ["doc_id", "line_no"], n).drop("_key")


def start_marked_words(line: Column) -> Column:
    """Words of a line, cut at U+0020 only, each with the word-start mark in front."""
    return F.transform(
        F.filter(F.split(line, " "), lambda w: w != ""), lambda w: F.concat(F.lit(WORD_START), w)
    )


def word_counts(lines: DataFrame) -> DataFrame:
    """``word, n`` over the training lines: words as ``start_marked_words`` cuts them, added up by the tasks
    in bounded memory before the exchange."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def counted(found: Counter[str]) -> pa.RecordBatch:
        found.pop("", None)
        columns = [pa.array([WORD_START + w for w in found], pa.string()), pa.array(found.values(), pa.int64())]
        found.clear()
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for batch in batches:
            for line in batch.column(0).to_pylist():
                if line:
                    found.update(line.split(" "))
                if len(found) >= HELD_WORDS:
                    yield counted(found)
        yield counted(found)

    rows = lines.select(F.make_valid_utf8("line").alias("line")).mapInArrow(count, "word string, n bigint")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def segment_counts(words: DataFrame) -> DataFrame:
    """``segment, n``: parts of words inside which pairs may form.

    A segment ends before a word-start mark, at a digit and at an excluded character, so
    digits stay single and no pair crosses a word start.
    """
    body = f"[^{WORD_START}{DIGIT_CLASS}{EXCLUDED_CLASS}]"
    pattern = f"{WORD_START}{body}+|{body}{{2,}}"
    return (
        words.select(F.explode(F.regexp_extract_all("word", F.lit(pattern), 0)).alias("segment"), "n")
        .groupBy("segment")
        .agg(F.sum("n").alias("n"))
    )


def word_alphabet(words: DataFrame) -> DataFrame:
    """``ch, n`` over the words, excluded characters left out."""
    return (
        words.select(F.explode(characters(F.col("word"))).alias("ch"), "n")
        .where(~F.col("ch").rlike(f"[{EXCLUDED_CLASS}]"))
        .groupBy("ch")
        .agg(F.sum("n").alias("n"))
    )


def pair_counts(segments: DataFrame, column: str = "segment") -> DataFrame:
    """``a, b, n``: neighbouring symbols, weighted by how often their segment occurs."""
    return (
        pair_rows(segments.select(column, "n"), column)
        .groupBy("p")
        .agg(F.sum("n").alias("n"))
        .select(F.substring("p", 1, 1).alias("a"), F.substring("p", 2, 1).alias("b"), "n")
    )


def pair_rows(table: DataFrame, column: str) -> DataFrame:
    """One row per pair of neighbours: two-character string ``p`` in place of ``column``.

    Positions are generated and cut inside compiled code. Long strings are first cut to
    windows that overlap by one character, since a cut costs as much as its position.
    """
    rest = [c for c in table.columns if c != column]
    last_start = F.char_length(column) - 1
    step = F.lit(PAIR_WINDOW - 1)
    windows = (
        table.where(last_start > 0)
        .select(*rest, column, F.explode(F.sequence(F.lit(1), last_start, step)).alias("_w"))
        .select(*rest, F.substring(F.col(column), F.col("_w"), F.lit(PAIR_WINDOW)).alias("_s"))
    )
    places = F.sequence(F.lit(1), F.char_length("_s") - 1)
    return windows.select(*rest, "_s", F.explode(places).alias("_i")).select(
        *rest, F.substring(F.col("_s"), F.col("_i"), F.lit(2)).alias("p")
    )
