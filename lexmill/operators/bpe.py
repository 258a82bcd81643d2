"""Byte-pair tokenizer over tables: encode in Arrow batches, decode inside the JVM."""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lexmill.operators.bpe_train import FIRST_MERGE_ID, MAX_VOCAB
from lexmill.operators.chars import joined_bytes, joined_bytes_sql, with_markers

WORD_CACHE = 200_000  # distinct words a Python worker remembers


def word_encoder(piece_ids: dict[str, int], first_byte: int = 3, cache_size: int = WORD_CACHE):
    """Function from one marked word to its ids.

    Repeatedly joins the neighbours whose joined piece has the smallest id, leftmost on
    ties; a heap keeps it near-linear for words of any length. What has no piece becomes
    its UTF-8 bytes.
    """
    cache: dict[str, list[int]] = {}

    def encode(word: str) -> list[int]:
        hit = cache.get(word)
        if hit is not None:
            return hit
        part = list(word)
        size = len(part)
        nxt = list(range(1, size + 1))
        prev = list(range(-1, size - 1))
        heap = []
        for i in range(size - 1):
            joined = piece_ids.get(part[i] + part[i + 1])
            if joined is not None:
                heap.append((joined, i, part[i], part[i + 1]))
        heapify(heap)
        while heap:
            _, i, left, right = heappop(heap)
            j = nxt[i] if part[i] is not None else size
            if j >= size or part[i] != left or part[j] != right:
                continue  # one side was merged away meanwhile
            part[i], part[j] = left + right, None
            nxt[i] = nxt[j]
            if nxt[i] < size:
                prev[nxt[i]] = i
            for k in (prev[i], i):
                if k >= 0 and nxt[k] < size:
                    joined = piece_ids.get(part[k] + part[nxt[k]])
                    if joined is not None:
                        heappush(heap, (joined, k, part[k], part[nxt[k]]))
        ids: list[int] = []
        for p in part:
            if p is not None:
                known = piece_ids.get(p)
                ids.extend([known] if known is not None else [first_byte + x for x in p.encode()])
        if len(cache) < cache_size and size <= 64:
            cache[word] = ids
        return ids

    return encode


def encode_udf(piece_ids: dict[str, int], cache_size: int = WORD_CACHE):
    """Arrow function from text to ids; no exchange, one pass over each whole text."""

    @F.arrow_udf("array<int>")
    def bpe_encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = word_encoder(piece_ids, cache_size=cache_size)
        for texts in batches:
            flat: list[int] = []
            ends = [0]
            for text in texts.to_pylist():
                # Runs of spaces vanish; a literal mark starts a word of its own.
                for word in (text or "").split(" "):
                    if word:
                        for part in word.split("▁"):
                            flat.extend(encode("▁" + part))
                ends.append(len(flat))
            yield pa.ListArray.from_arrays(
                pa.array(np.asarray(ends, dtype=np.int32)), pa.array(np.asarray(flat, dtype=np.int32))
            )

    return bpe_encode


class BpeTokenizer:
    """Byte-pair tokenizer built from a vocabulary table; at most 65,536 pieces."""

    unk, bos, eos, pad = 0, 1, 2, -1

    def __init__(self, pieces: list[str]):
        if not FIRST_MERGE_ID < len(pieces) <= MAX_VOCAB:
            raise ValueError("a byte-pair vocabulary holds bytes, characters and at most 65536 ids")
        self.pieces = list(pieces)
        self.vocab_size = len(self.pieces)

    @classmethod
    def from_vocab(cls, vocab: DataFrame) -> "BpeTokenizer":
        rows = vocab.select("id", "piece").limit(MAX_VOCAB + 1).collect()
        return cls([r["piece"] for r in sorted(rows, key=lambda r: r["id"])])

    def piece_ids(self) -> dict[str, int]:
        return {p: i for i, p in enumerate(self.pieces) if i >= FIRST_MERGE_ID}

    def encoder(self, cache_size: int = WORD_CACHE):
        return encode_udf(self.piece_ids(), cache_size)

    def encode(self, text: Column, bos: bool = False, eos: bool = False) -> Column:
        return with_markers(
            self.encoder()(text), self.bos if bos else None, self.eos if eos else None
        )

    def sql_functions(self) -> dict[str, str]:
        """Decoding as SQL: signature and body."""
        text = f"make_valid_utf8(CAST({joined_bytes_sql('ids', self._bytes_by_id(), '')} AS STRING))"
        return {"bpe_decode(ids ARRAY<INT>) RETURNS STRING": f"regexp_replace({text}, '^ ', '')"}

    def python_functions(self) -> dict:
        return {"bpe_encode": self.encoder()}

    def _bytes_by_id(self) -> list[str]:
        first = len(("<unk>", "<s>", "</s>"))
        table = []
        for i, p in enumerate(self.pieces):
            if i < first:
                table.append("")
            elif i < FIRST_MERGE_ID:
                table.append(f"{i - first:02X}")
            else:
                table.append(p.replace("▁", " ").encode().hex().upper())
        return table

    def decode(self, ids: Column) -> Column:
        """Bytes of all pieces joined and read as UTF-8; specials vanish, so does one
        leading space."""
        text = F.make_valid_utf8(joined_bytes(ids, self._bytes_by_id(), "").cast("string"))
        return F.when(text.startswith(" "), F.substring(text, 2, 2**31 - 1)).otherwise(text)


def encode_table(stripped: DataFrame, tokenizer) -> DataFrame:
    """``shard, ord, doc_id, n, tokens`` with begin and end markers, for any tokenizer."""
    rest = [c for c in stripped.columns if c not in ("title", "content")]
    tokens = tokenizer.encode(F.col("content"), bos=True, eos=True)
    return stripped.select(*rest, tokens.alias("tokens")).withColumn("n", F.size("tokens"))
