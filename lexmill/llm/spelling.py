"""Spelling variants: words one edit apart, found with bitsets over the vocabulary."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from lexmill.llm.common import columns, text_or_empty
from lexmill.session import drop_table, task_count, write_table

#: The letters of a word, and those that are lower-cased.
LETTERS = "[A-Za-z\u00c0-\u00ff]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One of so many (document, word) pairs loses a letter.
DAMAGED = 199
LEAST_LENGTH = 6
LEAST_COUNT = 5
#: How much more frequent a word's form must be.
RATIO = 5
#: Words of a bucket that are indexed together; a larger bucket is divided first.
INDEXED = 2_048


def damaged(row_id: Column, word: Column) -> Column:
    """The word, or without one letter for one of ``DAMAGED`` pairs of id and word."""
    h = F.crc32(F.concat(row_id, F.lit(":"), word).cast("binary"))
    place = (h % F.char_length(word)).cast("int")
    less = F.concat(F.substring(word, F.lit(1), place), F.substring(word, place + 2, F.char_length(word)))
    return F.when(h % DAMAGED == 0, less).otherwise(word)


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
) -> DataFrame:
    """``word, n`` of all words that are long and frequent enough, counted on the map side first."""
    low = F.translate(text_or_empty(text_col), UPPER, LOWER)
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(low, F.lit(LETTERS), F.lit(0))).alias("run"),
    ).where(F.char_length("run") >= least_length)
    words = runs.select(damaged(F.col("id"), F.col("run")).alias("word"))
    counted = words.where(F.char_length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= least_count)


def _divided(words: DataFrame) -> DataFrame:
    """Each row in two buckets: by what the word shares at the front, and at the back.

    A row carries the length ``long`` of the longer word of its pairs and the numbers ``front`` and
    ``back`` of letters that its bucket shares. Of the letters between, at most one differs, so two
    words of a pair share the first half of the others, or the last half. ``path`` tells the halves
    apart that were chosen on the way, ``cuts`` the fronts that a pair must not share, as it would
    be found there already.
    """
    half = F.ceil((F.col("long") - F.col("front") - F.col("back") - 1) / 2).cast("int")
    ahead = F.struct(
        (F.col("front") + half).alias("front"), F.col("back"), F.concat("path", F.lit("f")).alias("path"), F.col("cuts")
    )
    behind = F.struct(
        F.col("front"), (F.col("back") + half).alias("back"), F.concat("path", F.lit("b")).alias("path"),
        F.concat("cuts", F.array(F.col("front") + half)).alias("cuts"),
    )
    rows = words.select("word", "n", "long", F.inline(F.array(ahead, behind)))
    return rows.withColumn(
        "bucket",
        F.xxhash64(
            "long", "path", F.substring(F.col("word"), F.lit(1), F.col("front")),
            F.substring(F.col("word"), F.char_length("word") - F.col("back") + 1, F.col("back")),
        ),
    )


class PositionIndex:
    """Bitsets over words: which of them hold a letter at a place, and which have a length."""

    def __init__(self, words: list[str], skip: int = 0):
        self.at: list[dict[str, int]] = [defaultdict(int) for _ in range(max(map(len, words), default=0))]
        self.of_length: dict[int, int] = defaultdict(int)
        self.all = (1 << len(words)) - 1
        for k, word in enumerate(words):
            bit = 1 << k
            self.of_length[len(word)] |= bit
            for place in range(skip, len(word)):
                self.at[place][word[place]] |= bit

    def near(self, word: str, own: int, skip: int) -> int:
        """The words exactly one edit away; all words here share the first ``skip`` letters.

        ``same`` holds the words that agree so far. ``other``, ``less`` and ``more`` hold those with
        one error so far, which lie at the same place, one place behind and one ahead of ``word``.
        """
        at, none = self.at, {}
        size, last = len(word), len(self.at)
        same, other, less, more = self.all & ~own, 0, 0, 0
        for place in range(skip, size):
            letter = word[place]
            here = at[place].get(letter, 0) if place < last else 0
            behind = at[place - 1].get(letter, 0) if place > skip else 0
            ahead = (at[place + 1] if place + 1 < last else none).get(letter, 0)
            less = (less & behind) | same
            more = (more | same) & ahead
            other = (other & here) | (same & ~here)
            same &= here
            if not (same or other or less or more):
                return 0
        get = self.of_length.get
        return (other & get(size, 0)) | (less & get(size - 1, 0)) | ((more | same) & get(size + 1, 0))


def near_in_bucket(words: list[str], long: int, front: int, back: int, cuts: list[int]) -> Iterator[tuple[int, int]]:
    """``(k, bitset of the words near word k)`` for pairs whose longer word has ``long`` letters.

    Words are read from the back when the bucket shares more there; pairs of two shorter words and
    pairs that share one of the ``cuts`` belong to other buckets.
    """
    turned = back > front
    spelled = [w[::-1] for w in words] if turned else words
    skip = max(front, back)
    index = PositionIndex(spelled, skip)
    shared: list[dict[str, int]] = [defaultdict(int) for _ in cuts]
    for k, word in enumerate(words):
        for cut, sets in zip(cuts, shared):
            sets[word[:cut]] |= 1 << k
    longer = index.of_length.get(long, 0)
    for k, word in enumerate(words):
        found = index.near(spelled[k], 1 << k, skip)
        if len(word) < long:
            found &= longer
        for cut, sets in zip(cuts, shared):
            if found:
                found &= ~sets[word[:cut]]
        if found:
            yield k, found


def _compared(buckets: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best`` of every word with near ones in a bucket: their number, and the most frequent."""
    schema = columns(word="string", n_near="long", best_n="long", best="string")
    target = to_arrow_schema(schema)

    def run(batches):
        held, at, out = [], None, []

        def settle():
            _, long, front, back, cuts, _, _ = held[0]
            words, counts = [row[5] for row in held], [row[6] for row in held]
            for k, found in near_in_bucket(words, long, front, back, cuts):
                number, best = 0, None
                while found:
                    low = found & -found
                    j = low.bit_length() - 1
                    found ^= low
                    number += 1
                    if best is None or (-counts[j], words[j]) < best:
                        best = -counts[j], words[j]
                out.append((words[k], number, -best[0], best[1]))

        def table():
            rows = list(zip(*out)) or [()] * len(target)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, target)], schema=target)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != at:
                    if len(held) > 1:
                        settle()
                    held, at = [], row[0]
                held.append(row)
            if len(out) > 20_000:
                yield table()
        if len(held) > 1:
            settle()
        yield table()

    return buckets.select("bucket", "long", "front", "back", "cuts", "word", "n").mapInArrow(run, schema)


def near_words(words: DataFrame, indexed: int = INDEXED) -> DataFrame:
    """``word, n_near, best_n, best`` of every word of ``word, n`` that has a near one.

    Two words are near if one inserted, deleted or replaced code point makes one of the other.
    Every word joins the buckets of pairs in which it is the longer (or equally long) and the
    shorter one. A bucket of at most ``indexed`` words is indexed and compared; what is larger is
    divided by half of the letters that are still open, until one is: such a bucket holds no
    more words than there are letters. So no bucket grows with the vocabulary, and none is cut.
    """
    spark = words.sparkSession
    parts = task_count(spark)
    lengths = F.array(F.char_length("word"), F.char_length("word") + 1)
    zero = F.lit(0).alias("front"), F.lit(0).alias("back"), F.lit("").alias("path"), F.array().cast("array<int>").alias("cuts")
    level = _divided(words.select("word", "n", F.explode(lengths).alias("long"), *zero))
    found, large = [], None
    while True:
        rows, path = write_table(level, "word-buckets")
        sizes = rows.groupBy("bucket").agg(
            F.count(F.lit(1)).alias("members"), F.max(F.col("long") - F.col("front") - F.col("back")).alias("open")
        )
        small = (F.col("members") <= indexed) | (F.col("open") <= 1)
        big, _ = write_table(sizes.where(~small).select("bucket"), "large-buckets")
        held = sizes.where(small & (F.col("members") > 1)).select("bucket")
        dealt = rows.join(held, "bucket", "left_semi").repartition(parts, "bucket").sortWithinPartitions("bucket", "word")
        found.append(write_table(_compared(dealt), "near-words")[0])
        if large:
            drop_table(spark, large)
        if big.isEmpty():
            drop_table(spark, path)
            break
        level, large = _divided(rows.join(big, "bucket", "left_semi").drop("bucket")), path
    near = found[0]
    for more in found[1:]:
        near = near.unionByName(more)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best")))
    return (
        near.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("first"))
        .select("word", "n_near", (-F.col("first.less")).alias("best_n"), F.col("first.best").alias("best"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: forms are followed to the last, twice as far in each step.

    A form is ``RATIO`` times as frequent as its word, so chains are short and never close.
    """
    spark = forms.sparkSession
    now, path = write_table(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        after, new_path = write_table(
            now.join(further, "root", "left").select(
                "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")
            ),
            "roots",
        )
        drop_table(spark, path)
        now, path = after.select("word", "root"), new_path
        if after.where("moved").isEmpty():
            return now


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT, ratio: int = RATIO, indexed: int = INDEXED,
) -> DataFrame:
    """One row per word of the texts: ``word, form, root`` and ``n, n_near, form_n``.

    Words are runs of Latin letters, A to Z lower-cased, of at least ``least_length`` code points
    and ``least_count`` occurrences; one of ``DAMAGED`` pairs of document and word loses a letter
    first. A word's form is its most frequent near word (of equal ones the first in code-point order),
    if that is ``ratio`` times as frequent; ``root`` is where the forms lead, or the word itself.

    A null text has no words; a null id counts as the empty string. Repeated rows count as often.
    Very long texts and words are read whole. No words give no rows. Other columns are not read.
    """
    counted, _ = write_table(word_counts(docs, id_col, text_col, least_length, least_count), "word-counts")
    near = near_words(counted, indexed)
    chosen = F.col("best_n") >= ratio * F.col("n")
    table, _ = write_table(
        counted.join(near, "word", "left").select(
            "word", F.when(chosen, F.col("best")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(chosen, F.col("best_n")).alias("form_n"),
        ),
        "word-forms",
    )
    followed = roots(table.where("form is not null").select("word", "form"))
    return table.join(followed, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
