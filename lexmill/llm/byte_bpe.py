"""Byte-level byte-pair encoding with a hierarchical-bitmap queue of merge ranks."""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from lexmill.llm.common import columns, map_rows, text_or_empty

#: Pre-tokens of more bytes are encoded one by one, shorter ones together.
LONG = 256
#: Bytes of short pre-tokens that go through the queue together.
TOGETHER = 1 << 20
#: Pre-tokens that a worker remembers; beyond, they are encoded each time.
REMEMBERED = 600_000
NONE = 1 << 30


class RankQueue:
    """Buckets of positions by merge rank, under a bitmap of three levels of 64-bit words.

    A bit of the lowest level says that a rank's bucket has entries, a bit of a higher level that
    a word below is not zero. Finding the first set bit once per level gives the lowest rank.
    Entries are never removed early: whoever takes a bucket skips those that no longer hold.
    """

    def __init__(self, ranks: int, ordered: bool = False):
        self.ordered = ordered
        self.levels = [[0] * max(1, -(-ranks // 64**k)) for k in (1, 2, 3)]
        self.buckets: dict[int, list] = {}

    def push(self, rank: int, entry) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [entry]
            for level in self.levels:
                rank, bit = rank >> 6, rank & 63
                level[rank] |= 1 << bit
        else:
            heapq.heappush(bucket, entry) if self.ordered else bucket.append(entry)

    def pop(self, rank: int):
        """The smallest entry of an ordered bucket."""
        bucket = self.buckets[rank]
        entry = heapq.heappop(bucket)
        if not bucket:
            self.take(rank)
        return entry

    def lowest(self) -> int:
        """The lowest rank with entries, or -1."""
        word = next((k for k, w in enumerate(self.levels[2]) if w), -1)
        if word < 0:
            return -1
        for level in reversed(self.levels):
            w = level[word]
            word = word << 6 | (w & -w).bit_length() - 1
        return word

    def take(self, rank: int) -> list:
        """The entries of a rank; its bucket is empty then."""
        entries = self.buckets.pop(rank)
        for level in self.levels:
            word, bit = rank >> 6, rank & 63
            level[word] &= ~(1 << bit)
            if level[word]:
                break
            rank = word
        return entries


class ByteBpe:
    """Encoder and decoder for a rank file; a token's id is its rank."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            pairs = (line.split() for line in file if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.size = max(self.ranks.values()) + 1
        self.bytes_of = [b""] * self.size
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        #: left id * size + right id of every pair that makes a token, sorted; and the token.
        made: dict[int, int] = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    made[left * self.size + right] = rank
        self.pairs = made
        self.pair_keys = np.array(sorted(made), np.int64)
        self.pair_ranks = np.array([made[k] for k in self.pair_keys.tolist()], np.int64)

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NONE)

    def encode_long(self, data: bytes) -> list[int]:
        """One pre-token: positions form a linked list, the queue gives the next merge.

        Of equal ranks the leftmost position goes first; stale entries are skipped.
        """
        if not data:
            return []
        token = self.of_byte[np.frombuffer(data, np.uint8)].tolist()
        n, size, pairs = len(token), self.size, self.pairs
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        rank = [pairs.get(token[i] * size + token[i + 1], NONE) for i in range(n - 1)] + [NONE]
        queue = RankQueue(size, ordered=True)
        for i, r in enumerate(rank):
            if r < NONE:
                queue.push(r, i)
        while (r := queue.lowest()) >= 0:
            i = queue.pop(r)
            if rank[i] != r:
                continue
            gone = after[i]
            token[i] = r
            rank[gone] = rank[i] = NONE
            after[i] = nxt = after[gone]
            if nxt < n:
                before[nxt] = i
                rank[i] = pairs.get(r * size + token[nxt], NONE)
                if rank[i] < NONE:
                    queue.push(rank[i], i)
            if (prev := before[i]) >= 0:
                rank[prev] = pairs.get(token[prev] * size + r, NONE)
                if rank[prev] < NONE:
                    queue.push(rank[prev], prev)
        out, i = [], 0
        while i < n:
            out.append(token[i])
            i = after[i]
        return out

    def encode_short(self, words: list[bytes]) -> list[np.ndarray]:
        """Many pre-tokens at once, each as ``encode_long`` would: one queue holds all their positions.

        Merges of different pre-tokens do not touch, so the first position of every pre-token in
        the lowest bucket is merged in one step; further ones of the same pre-token wait.
        """
        if not words:
            return []
        lengths = np.array([len(w) for w in words], np.int64)
        token = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        n = len(token)
        word = np.repeat(np.arange(len(words)), lengths)
        after = np.arange(1, n + 1)
        before = np.arange(-1, n - 1)
        inner = np.append(word[1:] == word[:-1], False)  # has a right neighbour in its pre-token
        rank = np.full(n + 1, NONE, np.int64)
        at = np.flatnonzero(inner)
        rank[at] = self._ranks_of(token[at], token[at + 1])
        alive = np.ones(n, bool)
        has_right = inner.copy()
        has_left = np.insert(inner[:-1], 0, False) if n else inner
        queue = RankQueue(self.size)

        def push(positions: np.ndarray) -> None:
            order = np.argsort(rank[positions], kind="stable")
            positions = positions[order]
            ranks = rank[positions]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            starts = [0, *cuts.tolist(), len(ranks)]
            for a, b, r in zip(starts, starts[1:], ranks[starts[:-1]].tolist()):
                queue.push(r, positions[a:b])

        if len(first := np.flatnonzero(rank[:n] < NONE)):
            push(first)
        while (r := queue.lowest()) >= 0:
            entries = queue.take(r)
            at = entries[0] if len(entries) == 1 else np.unique(np.concatenate(entries))
            at = at[rank[at] == r]  # the others are stale
            if not len(at):
                continue
            own = word[at]
            if len(at) > 1:
                again = np.append(False, own[1:] == own[:-1])
                if again.any():
                    queue.push(r, at[again])
                    at = at[~again]
            gone = after[at]
            token[at] = r
            rank[gone] = NONE
            alive[gone] = False
            after[at] = nxt = after[gone]
            more = has_right[gone]
            has_right[at] = more
            right_at, right = at[more], nxt[more]
            before[right] = right_at
            rank[at] = NONE
            rank[right_at] = self._ranks_of(token[right_at], token[right])
            left_at = at[has_left[at]]
            left = before[left_at]
            rank[left] = self._ranks_of(token[left], token[left_at])
            new = np.concatenate((right_at, left))
            new = new[rank[new] < NONE]
            if len(new) == 1:
                queue.push(int(rank[new[0]]), new)
            elif len(new):
                push(new)
        ids = token[alive].astype("<u2" if self.size <= 1 << 16 else "<u4")
        ends = np.cumsum(np.bincount(word[alive], minlength=len(words)))
        return np.split(ids, ends[:-1])

    def encode_words(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        """The ids of distinct pre-tokens, as little-endian integers."""
        kind = "<u2" if self.size <= 1 << 16 else "<u4"
        out: dict[bytes, bytes] = {}
        batch: list[bytes] = []
        held = 0

        def flush():
            out.update(zip(batch, (ids.tobytes() for ids in self.encode_short(batch))))
            batch.clear()

        for w in words:
            if w in self.ranks:
                out[w] = np.array([self.ranks[w]], kind).tobytes()
            elif len(w) > LONG:
                out[w] = np.array(self.encode_long(w), kind).tobytes()
            else:
                batch.append(w)
                held += len(w)
                if held >= TOGETHER:
                    flush()
                    held = 0
        flush()
        return out

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class TextCoder:
    """Encodes whole texts, pre-token by pre-token, remembering pre-tokens up to a bound."""

    def __init__(self, path: str, pattern: str):
        self.bpe = ByteBpe(path)
        self.split = regex.compile(pattern).findall
        self.kind = "<u2" if self.bpe.size <= 1 << 16 else "<u4"
        self.known: dict[str, bytes] = {}

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        pieces = [self.split(t) for t in texts]
        known, lookup = self.known, self.known
        missing = set().union(*pieces).difference(known)
        if missing:
            names = list(missing)
            found = self.bpe.encode_words(w.encode("utf-8", "replace") for w in names)
            new = {w: found[w.encode("utf-8", "replace")] for w in names}
            if len(known) + len(new) <= REMEMBERED:
                known.update(new)
            else:
                lookup = {w: known[w] for w in set().union(*pieces) if w in known} | new
        return [np.frombuffer(b"".join(map(lookup.__getitem__, p)), self.kind) for p in pieces]


_coders: dict[tuple[str, str], TextCoder] = {}


def coder(path: str, pattern: str) -> TextCoder:
    """One coder per worker process; tables are built from the file where the task runs."""
    if (path, pattern) not in _coders:
        _coders[path, pattern] = TextCoder(path, pattern)
    return _coders[path, pattern]


def encode_documents(
    docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN,
    id_col: str = "doc_id", text_col: str = "text", decode: bool = False,
) -> DataFrame:
    """One row per input row: ``id_col, ids`` and, on request, ``decoded`` (the bytes of the ids).

    Each match of the pattern is encoded by itself, without special tokens. A null text is the
    empty text and has no ids; ids may be null or repeated. Whole texts are encoded; a very long
    pre-token goes through the queue alone, in time that follows its length. The rank file must
    be at the same path on every machine. Other columns are not read.
    """
    return _mapped(docs, path, pattern, id_col, text_col, decode, digests=False)


def token_digests(
    docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256`` of ``encode_documents``, summed up where
    the ids are made: decimal ids joined by one space, and the decoded bytes."""
    return _mapped(docs, path, pattern, id_col, text_col, True, digests=True)


def _mapped(docs, path, pattern, id_col, text_col, decode, digests):
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    source = docs.select(F.col(id_col).alias("row_id"), text_or_empty(text_col).alias("body"))
    if digests:
        out = columns(n_tokens="long", ids_sha256="string", decoded_sha256="string")
    else:
        out = columns(ids="longs", decoded="binary") if decode else columns(ids="longs")
    schema = StructType([source.schema["row_id"], *out.fields])

    def make():
        use = coder(path, pattern)
        decimal = [str(i) for i in range(use.bpe.size)]

        def apply(rows, texts):
            found = use.encode_batch(texts)
            given = {"row_id": rows}
            if not digests:
                given["ids"] = [ids.astype(np.int64) for ids in found]
                if decode:
                    given["decoded"] = [use.bpe.decode(ids.tolist()) for ids in found]
                return given
            sums = []
            for ids in found:
                own = ids.tolist()
                sums.append((
                    len(own), hashlib.sha256(" ".join(map(decimal.__getitem__, own)).encode()).hexdigest(),
                    hashlib.sha256(use.bpe.decode(own)).hexdigest(),
                ))
            return given | dict(zip(out.fieldNames(), zip(*sums)))

        return apply

    return map_rows(source, schema, make).withColumnRenamed("row_id", id_col)
