"""Character tokenizer: code-point lookup tables, for encoding in Arrow batches, for decoding inside the JVM."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lexmill.functions.text import code_points, text_ends

MAX_CODE_POINTS = 0x110000


def encode_udf(id_of: dict[int, int], unk: int):
    """Arrow function from text to the ids of its code points; a null text has null ids."""
    table = np.full(MAX_CODE_POINTS, unk, np.int32)
    for code, i in id_of.items():
        table[code] = i
    table = table[: max(id_of, default=0) + 2]  # the last entry is unknown and stands for all beyond

    @F.arrow_udf("array<int>")
    def char_encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            ids = [table[np.minimum(points, len(table) - 1)] for points in code_points(texts)]
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            yield pa.ListArray.from_arrays(pa.array(text_ends(texts)), pa.array(flat), mask=texts.is_null())

    return char_encode


class CharTokenizer:
    """Maps characters to ids and back; unknown characters become ``<unk>``."""

    bos, eos, unk, pad = 0, 1, 2, -1

    def __init__(self, pieces: dict[str, int]):
        self.pieces = dict(pieces)
        self.vocab_size = len(self.pieces)

    @classmethod
    def from_vocab(cls, vocab: DataFrame) -> "CharTokenizer":
        """A vocabulary has at most one row per code point, so it fits the driver."""
        rows = vocab.select("ch", "id").limit(MAX_CODE_POINTS + 4).collect()
        if len(rows) > MAX_CODE_POINTS + 3:
            raise ValueError("a character vocabulary has more rows than code points")
        return cls({r["ch"]: r["id"] for r in rows})

    def _ids_by_code(self) -> str:
        by_code = {ord(c): i for c, i in self.pieces.items() if len(c) == 1}
        return ",".join(str(by_code.get(c, self.unk)) for c in range(max(by_code, default=0) + 1))

    def _bytes_by_id(self) -> tuple[list[str], str]:
        unknown = b"<unk>".hex()
        by_id = {i: c.encode().hex() for c, i in self.pieces.items()}
        return [by_id.get(i, unknown) for i in range(max(by_id, default=0) + 1)], unknown

    def sql_functions(self) -> dict[str, str]:
        """The two directions as SQL: signature and body."""
        ids = f"get(CAST(split('{self._ids_by_code()}', ',') AS ARRAY<INT>), ascii(c))"
        encode = f"transform(filter(split(t, ''), c -> c <> ''), c -> coalesce({ids}, {self.unk}))"
        return {
            "char_encode(t STRING) RETURNS ARRAY<INT>": encode,
            "char_decode(ids ARRAY<INT>) RETURNS STRING": f"CAST({joined_bytes_sql('ids', *self._bytes_by_id())} AS STRING)",
        }

    def python_functions(self) -> dict:
        return {}

    def encode(self, text: Column, bos: bool = False, eos: bool = False) -> Column:
        # A table by code point: the lookup costs the same for any alphabet.
        body = encode_udf({ord(c): i for c, i in self.pieces.items() if len(c) == 1}, self.unk)(F.make_valid_utf8(text))
        return with_markers(body, self.bos if bos else None, self.eos if eos else None)

    def decode(self, ids: Column) -> Column:
        return joined_bytes(ids, *self._bytes_by_id()).cast("string")


def joined_bytes(ids: Column, hex_table: list[str], default: str) -> Column:
    """Bytes of all ids in a row; ``hex_table`` holds the bytes of each id in hexadecimal."""
    table = F.split(F.lit(",".join(hex_table)), ",")
    pieces = F.transform(ids, lambda i: F.coalesce(F.get(table, i), F.lit(default)))
    return F.unhex(F.array_join(pieces, ""))


def joined_bytes_sql(ids: str, hex_table: list[str], default: str) -> str:
    """``joined_bytes`` as a SQL expression."""
    table = f"split('{','.join(hex_table)}', ',')"
    return f"unhex(array_join(transform({ids}, i -> coalesce(get({table}, i), '{default}')), ''))"


def with_markers(ids: Column, bos: int | None, eos: int | None) -> Column:
    """Put the begin and end ids around a token array; each side is optional."""
    parts = [F.array(F.lit(bos))] if bos is not None else []
    parts.append(ids)
    if eos is not None:
        parts.append(F.array(F.lit(eos)))
    return F.concat(*parts) if len(parts) > 1 else ids
