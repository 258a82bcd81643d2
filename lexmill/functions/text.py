"""Text columns: strip, words, lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

TEXTS_TOGETHER = 500  # texts of a batch whose code points are held at a time
# The 29 characters that Python's str.strip and str.split treat as
# white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a regular-expression class body.
WHITESPACE_CLASS = (
    r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def strip(text: Column) -> Column:
    """Drop white space at both ends; looks at the ends only, not at the whole text."""
    return F.btrim(text, F.lit(WHITESPACE))


def words(text: Column) -> Column:
    """Runs of non-white-space characters."""
    return F.filter(F.split(text, f"[{WHITESPACE_CLASS}]+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def characters(text: Column) -> Column:
    """Code points of a text; the empty text has none."""
    return F.filter(F.split(text, ""), lambda c: c != "")


def lines(text: Column) -> Column:
    return F.split(text, "\n")


def code_points(texts: pa.Array) -> Iterator[np.ndarray]:
    """Code points of all texts of an Arrow batch one after the other, a few texts at a time."""
    for at in range(0, len(texts), TEXTS_TOGETHER):
        joined = "".join(t for t in texts.slice(at, TEXTS_TOGETHER).to_pylist() if t)
        yield np.frombuffer(joined.encode("utf-32-le"), "<u4")


def text_ends(texts: pa.Array) -> np.ndarray:
    """Where each text of an Arrow batch begins and ends in its code points (null: empty)."""
    lengths = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False)
    return np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
