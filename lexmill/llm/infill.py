"""Fill-in-the-middle texts by block rotation in place, and the way back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lexmill.llm.common import SLICE_ROWS, text_or_empty

#: What opens the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 texts, those that stay plain, and of 100 others, those that begin with the suffix.
PLAIN_PERCENT = 10
SUFFIX_FIRST_PERCENT = 20
#: Bytes that a reversal or a scan holds beside the text.
BLOCK = 1 << 16


def reverse(buffer: bytearray, start: int, stop: int) -> None:
    """Turn a segment round in place, block by block from both ends."""
    while stop - start > 1:
        k = min(BLOCK, (stop - start) // 2)
        left, right = buffer[start : start + k], buffer[stop - k : stop]
        left.reverse()
        right.reverse()
        buffer[start : start + k], buffer[stop - k : stop] = right, left
        start, stop = start + k, stop - k


def rotate(buffer: bytearray, start: int, middle: int, stop: int) -> None:
    """Exchange the neighbouring segments ``start:middle`` and ``middle:stop`` by three reversals."""
    reverse(buffer, start, middle)
    reverse(buffer, middle, stop)
    reverse(buffer, start, stop)


def byte_offsets(data: bytes, points: tuple[int, int]) -> list[int]:
    """The byte offsets of two code-point offsets, the smaller first; one scan of UTF-8 text."""
    if data.isascii():
        return list(points)
    found, seen, wanted = [], 0, list(points)
    for at in range(0, len(data), BLOCK):
        leads = (np.frombuffer(data, np.uint8, min(BLOCK, len(data) - at), at) & 0xC0) != 0x80
        count = int(leads.sum())
        while wanted and wanted[0] < seen + count:
            found.append(at + int(np.flatnonzero(leads)[wanted.pop(0) - seen]))
        if not wanted:
            break
        seen += count
    return found + [len(data)] * len(wanted)


def arrange(text: bytes, form: str, prefix: int, stop: int) -> bytes:
    """``text`` in its form; the prefix ends at code point ``prefix``, the middle at ``stop``."""
    if form == "plain":
        return text
    first, second = byte_offsets(text, (prefix, stop))
    p, m, s = PREFIX.encode(), MIDDLE.encode(), SUFFIX.encode()
    buffer = bytearray(text)
    buffer[second:second] = s
    buffer[first:first] = m
    buffer[0:0] = p
    middle, suffix = len(p) + first, len(p) + len(m) + second
    # psm exchanges middle and suffix, spm exchanges all before the suffix and the suffix.
    rotate(buffer, middle if form == "psm" else 0, suffix, len(buffer))
    return bytes(buffer)


def restore(output: bytes, form: str) -> bytes:
    """The text that ``arrange`` got: the rotation is inverted, then the marks go."""
    if form == "plain":
        return output
    p, m, s = PREFIX.encode(), MIDDLE.encode(), SUFFIX.encode()
    buffer = bytearray(output)
    if form == "psm":  # prefix, suffix, middle
        suffix, middle = buffer.find(s), buffer.find(m)
        rotate(buffer, suffix, middle, len(buffer))
        first, second = suffix, suffix + len(buffer) - middle
    else:  # suffix, prefix, middle
        prefix, middle = buffer.find(p), buffer.find(m)
        rotate(buffer, 0, prefix, len(buffer))
        first, second = middle - prefix, len(buffer) - prefix
    del buffer[second : second + len(s)]
    del buffer[first : first + len(m)]
    del buffer[: len(p)]
    return bytes(buffer)


def _by_rows(function):
    """An Arrow function from one that takes plain values, a slice of rows at a time."""

    @F.arrow_udf("binary")
    def apply(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for columns in batches:
            parts = [pa.array([], pa.binary())]
            for at in range(0, len(columns[0]), SLICE_ROWS):
                rows = zip(*(c.slice(at, SLICE_ROWS).to_pylist() for c in columns))
                parts.append(pa.array([function(*row) for row in rows], pa.binary()))
            yield pa.concat_arrays(parts)

    return apply


def arranged(text: Column, form: Column, prefix: Column, stop: Column) -> Column:
    """``arrange`` as a column of bytes."""
    return _by_rows(arrange)(text.cast("binary"), form, prefix, stop)


def restored(output: Column, form: Column) -> Column:
    """``restore`` as a column of bytes: the exact text again, from output and form alone."""
    return _by_rows(restore)(output.cast("binary"), form)


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = "1",
    plain_percent: int = PLAIN_PERCENT, suffix_first_percent: int = SUFFIX_FIRST_PERCENT,
) -> DataFrame:
    """One row per input row: ``id_col, n, form, prefix_chars, middle_chars, output`` (bytes in UTF-8).

    The first four 8-digit groups of the hex SHA-256 of ``seed:id`` decide: two of them, modulo
    n + 1, are the cuts in code points, the third keeps the text plain, the fourth puts the suffix
    first. An empty text, and one that holds a mark, stays plain, so a mark in the output of another
    form is always one that was inserted. Lengths of plain texts are null.

    A null text is the empty text. A null id is hashed as the empty string; equal ids give equal
    cuts for equal texts, and repeated rows stay repeated. No rows give no rows. Whole texts are
    arranged, in memory of one text and two blocks. Other columns are not read.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring("__h", 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]
    text = F.col("__text")
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    plain = (F.col("n") == 0) | marked | (h[2] % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(h[3] % 100 < suffix_first_percent, "spm").otherwise("psm")
    cuts = [h[k] % (F.col("n") + 1) for k in (0, 1)]
    return (
        docs.select(F.col(id_col), text_or_empty(text_col).alias("__text"), digest.alias("__h"))
        .withColumn("n", F.char_length("__text").cast("long"))
        .select(id_col, "__text", "n", form.alias("form"), F.least(*cuts).alias("__first"), F.greatest(*cuts).alias("__second"))
        .select(
            id_col, "n", "form",
            F.when(F.col("form") != "plain", F.col("__first")).alias("prefix_chars"),
            F.when(F.col("form") != "plain", F.col("__second") - F.col("__first")).alias("middle_chars"),
            arranged(F.col("__text"), F.col("form"), F.col("__first"), F.col("__second")).alias("output"),
        )
    )
