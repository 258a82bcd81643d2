"""Byte-pair vocabulary training over a distributed table of word segments.

A round asks for the most frequent pairs, cuts all segments where a rarer pair stands, and adds up
equal parts. Those few parts hold every pair that can come before the rarer ones, so the driver
takes many merges from them, exactly, with an index from each pair to the parts that hold it.
Then the executors apply the new merges. A merged symbol is a single private code point.
"""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict
from collections.abc import Iterator
from operator import add

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lexmill import schemas
from lexmill.operators.vocab import covered_alphabet, pair_rows, segment_counts, word_alphabet
from lexmill.session import drop_table, task_count, write_table

SPECIALS = ["<unk>", "<s>", "</s>"]
N_BYTES = 256
FIRST_MERGE_ID = len(SPECIALS) + N_BYTES
MAX_VOCAB = 65_536  # ids fit uint16
MAX_PIECE = 16  # characters, word-start mark included
PRIVATE_START = 0xF0000
ROWS_PER_TASK = 20_000  # segments per task of a round, up to the tasks of the cluster
FIRST_PAIRS = 64  # most frequent pairs that the first round keeps together
MOST_PAIRS = 16_384
MOST_PARTS = 100_000  # distinct parts that a round may bring to the driver
HELD_PARTS = 50_000  # distinct parts that a task adds up before they leave it


class PartIndex:
    """Parts of segments with their weights, and for each pair its count and the parts that hold it.

    A merge touches only the parts of its pair. Pairs lie in a heap by count, ties by their
    pieces; an entry whose count has changed meanwhile is skipped.
    """

    def __init__(self, parts: dict[str, int], piece: dict[str, str]):
        self.parts, self.weights = list(parts), list(parts.values())
        self.piece = piece
        self.counts: Counter[str] = Counter()
        self.holders: dict[str, set[int]] = defaultdict(set)
        for k, (part, n) in enumerate(parts.items()):
            for pair in map("".join, zip(part, part[1:])):
                self.counts[pair] += n
                self.holders[pair].add(k)
        self.heap = [self._entry(pair) for pair in self.counts]
        heapq.heapify(self.heap)

    def _entry(self, pair: str) -> tuple[int, str, str, str]:
        return -self.counts[pair], self.piece[pair[0]], self.piece[pair[1]], pair

    def best(self) -> tuple[int, str] | None:
        """Count and symbols of the first pair; it leaves the heap."""
        while self.heap:
            n, _, _, pair = heapq.heappop(self.heap)
            if n and -n == self.counts[pair]:
                return -n, pair
        return None

    def merge(self, pair: str, symbol: str) -> None:
        changed = set()
        for k in self.holders.pop(pair):
            before, n = self.parts[k], self.weights[k]
            self.parts[k] = after = before.replace(pair, symbol)
            for old in map("".join, zip(before, before[1:])):
                self.counts[old] -= n
                changed.add(old)
            for new in map("".join, zip(after, after[1:])):
                self.counts[new] += n
                self.holders[new].add(k)
                changed.add(new)
        for one in changed:
            if self.counts[one] > 0:
                heapq.heappush(self.heap, self._entry(one))


class Merges:
    """Merges in order, and the code points that stand for their pieces."""

    def __init__(self, alphabet: set[str], max_piece: int):
        self.made: list[tuple[str, str]] = []
        self.code = {c: c for c in alphabet}
        self.piece = dict(self.code)
        self.max_piece = max_piece
        self._free = (chr(i) for i in range(PRIVATE_START, 0x110000) if chr(i) not in alphabet)

    def open(self, pair: str) -> bool:
        """Whether a pair may be merged: its piece is new and not too long."""
        joined = self.piece[pair[0]] + self.piece[pair[1]]
        return len(joined) <= self.max_piece and joined not in self.code

    def add(self, pair: str) -> str:
        a, b = self.piece[pair[0]], self.piece[pair[1]]
        symbol = self.code[a + b] = next(self._free)
        self.piece[symbol] = a + b
        self.made.append((a, b))
        return symbol

    def take(self, index: PartIndex, floor: int, limit: int) -> None:
        """Merges whose count is over ``floor``, until there are ``limit``.

        Counts only fall, and a new pair is at most as frequent as the pair of symbols at its border
        was, so whatever is over the floor has all its occurrences inside the parts.
        """
        while len(self.made) < limit and (best := index.best()) and best[0] > floor:
            if self.open(best[1]):
                index.merge(best[1], self.add(best[1]))


def _batch(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def spelled_pairs(counts: DataFrame, merges: Merges) -> DataFrame:
    """``n, a, b, p, open`` of the pairs ``p, n`` that are short enough to matter."""
    piece, made, longest = dict(merges.piece), set(merges.code), merges.max_piece
    schema = pa.schema([("n", pa.int64()), ("a", pa.string()), ("b", pa.string()), ("p", pa.string()), ("open", pa.bool_())])

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(n, piece[p[0]], piece[p[1]], p) for p, n in zip(*(c.to_pylist() for c in batch.columns))]
            rows = [(n, a, b, p, a + b not in made) for n, a, b, p in rows if len(a + b) <= longest]
            yield _batch(list(zip(*rows)) or [()] * len(schema), schema)

    return counts.select("p", "n").mapInArrow(spell, "n bigint, a string, b string, p string, open boolean")


def cut_parts(segments: DataFrame, together: set[str]) -> DataFrame:
    """``part, n``: segments ``s, n`` cut at all pairs but those in ``together``, equal parts added up."""
    schema = pa.schema([("part", pa.string()), ("n", pa.int64())])
    kept = together.__contains__

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for batch in batches:
            for s, n in zip(*(c.to_pylist() for c in batch.columns)):
                # One byte for each pair: 1 where it is kept together. Runs of ones are the parts.
                start = 0
                for run in bytes(map(kept, map(add, s, s[1:]))).split(b"\0"):
                    end = start + len(run) + 1
                    if run:
                        found[s[start:end]] += n
                    start = end
            if len(found) >= HELD_PARTS:
                yield _batch([list(found), list(found.values())], schema)
                found.clear()
        yield _batch([list(found), list(found.values())], schema)

    rows = segments.select("s", "n").mapInArrow(cut, "part string, n bigint")
    return rows.groupBy("part").agg(F.sum("n").alias("n"))


def apply_merges(segments: DataFrame, new: list[tuple[str, str]]) -> DataFrame:
    """Segments ``s, n`` after the merges ``(pair, symbol)``; one that became one symbol has no pairs left."""
    ranks = {pair: k for k, (pair, _) in enumerate(new)}
    symbols, pairs = dict(new), frozenset(ranks)
    schema = pa.schema([("s", pa.string()), ("n", pa.int64())])

    def merged(s: str) -> str:
        while found := pairs.intersection(map(add, s, s[1:])):
            first = min(found, key=ranks.__getitem__)
            s = s.replace(first, symbols[first])
        return s

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(merged(s), n) for s, n in zip(*(c.to_pylist() for c in batch.columns))]
            rows = [row for row in rows if len(row[0]) > 1]
            yield _batch(list(zip(*rows)) or [()] * 2, schema)

    return segments.select("s", "n").mapInArrow(run, "s string, n bigint")


class SegmentTable:
    """The segments as a written table, replaced by each round."""

    def __init__(self, segments: DataFrame):
        self.spark = segments.sparkSession
        self.now, self.path = write_table(segments.select(F.col("segment").alias("s"), "n"), "segments")
        # Every round scans this table: cut it to even parts that keep the cores busy.
        parts = max(1, min(task_count(self.spark), self.now.count() // ROWS_PER_TASK))
        self.replace(self.now.repartition(parts, "s"))

    def replace(self, segments: DataFrame) -> None:
        now, path = write_table(segments, "segments")
        self.close()
        self.now, self.path = now, path

    def pairs(self) -> DataFrame:
        return pair_rows(self.now, "s").groupBy("p").agg(F.sum("n").alias("n"))

    def close(self) -> None:
        drop_table(self.spark, self.path)


def learn_merges(
    segments: DataFrame, n_merges: int, alphabet: set[str], max_piece: int = MAX_PIECE
) -> list[tuple[str, str]]:
    """The ordered merge list: most frequent pair first, ties by the pieces themselves.

    The number of pairs kept together follows the number of parts that they give, which is all that
    comes to the driver: at most ``MOST_PARTS``, and ``MOST_PAIRS`` pairs. A round takes at least one merge.
    """
    merges = Merges(alphabet, max_piece)
    table = SegmentTable(segments)
    width = FIRST_PAIRS
    try:
        while len(merges.made) < n_merges:
            known = len(merges.made)
            counts, path = write_table(spelled_pairs(table.pairs(), merges), "pairs")
            order = [F.desc("n"), "a", "b"]
            ranked = counts.orderBy(*order).limit(width + 1).collect()
            while width:
                floor = ranked[width]["n"] if len(ranked) > width else 0
                found = cut_parts(table.now, {r["p"] for r in ranked[:width]}).limit(MOST_PARTS + 1).collect()
                if len(found) <= MOST_PARTS:
                    merges.take(PartIndex({r["part"]: r["n"] for r in found}, merges.piece), floor, n_merges)
                    break
                width //= 2
            if len(merges.made) == known:
                # More ties than fit: the very first pair that may be merged.
                first = counts.where("open").orderBy(*order).first()
                if first is not None:
                    merges.add(first["p"])
            drop_table(table.spark, path)
            if len(merges.made) == known:
                break
            growth = 4 if len(found) * 16 < MOST_PARTS else 2 if len(found) * 4 < MOST_PARTS else 1
            width = min(MOST_PAIRS, max(1, width) * growth)
            new = [(merges.code[a] + merges.code[b], merges.code[a + b]) for a, b in merges.made[known:]]
            if len(merges.made) < n_merges:
                table.replace(apply_merges(table.now, new))
    finally:
        table.close()
    return merges.made


def vocab_rows(merges: list[str], alphabet: list[str]) -> list[tuple[int, str, float, str]]:
    """Specials, byte pieces, merges in order, characters by frequency."""
    rows = [(p, "special") for p in SPECIALS]
    rows += [(f"<0x{i:02X}>", "byte") for i in range(N_BYTES)]
    rows += [(m, "merge") for m in merges] + [(c, "char") for c in alphabet]
    return [
        (i, p, -float(i - FIRST_MERGE_ID) if i > FIRST_MERGE_ID else 0.0, kind)
        for i, (p, kind) in enumerate(rows)
    ]


def train_vocab(words: DataFrame, vocab_size: int, max_piece: int = MAX_PIECE) -> DataFrame:
    """``id, piece, score, kind`` from a ``word, n`` table, with full character coverage.

    No piece is longer than ``max_piece`` characters (default 16, the word-start mark included).
    """
    if not 0 < vocab_size <= MAX_VOCAB:
        raise ValueError("vocabulary size must be positive and at most 65536")
    spark = words.sparkSession
    words, path = write_table(words, "words")
    try:
        top = covered_alphabet(word_alphabet(words)).orderBy("rank").limit(MAX_VOCAB).collect()
        alphabet = [r["ch"] for r in top]
        n_merges = vocab_size - FIRST_MERGE_ID - len(alphabet)
        if n_merges < 0:
            raise ValueError(f"{vocab_size} ids cannot hold bytes and {len(alphabet)} characters")
        merges = learn_merges(segment_counts(words), n_merges, set(alphabet), max_piece)
    finally:
        drop_table(spark, path)
    if len(merges) < n_merges:
        raise ValueError(f"the text yields {len(merges)} merges, {n_merges} are needed")
    rows = vocab_rows([a + b for a, b in merges], alphabet)
    return spark.createDataFrame(rows, schemas.VOCAB)
