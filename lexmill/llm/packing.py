"""Packing examples into sequences: vector bin packing by the dot-product heuristic."""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable
from dataclasses import dataclass
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from lexmill.llm.common import columns, map_rows, text_or_empty

#: Fixed value: the id that ends a document.
END_ID = 1
#: Words, and parts of words, of a generation; a worker remembers two.
GENERATION = 500_000
#: Words or parts that are encoded in one call.
TOGETHER = 10_000
#: Characters at which the rows of a task that wait to be encoded are encoded together.
SLICE_CHARS = 8_000_000
#: Examples that compete for a sequence.
CANDIDATES = 1_024
#: Shortest piece that a cut may leave.
MIN_PIECE = 4
#: Sequence ids of a task start at its partition number times this.
IDS_PER_TASK = 1 << 36

# Words of ASCII and Latin letters that the tokenizer's normal form only lower-cases, and, in lower case, the parts that
# it encodes apart, as Arrow's patterns. U+0130 is left out: its lower case is two characters.
PLAIN = r"^[!-~\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{17f}]+$"
PARTS = r"('s|'t|'re|'ve|'m|'ll|'d|[a-z\x{df}-\x{17f}]+|[0-9]|[^a-z\x{df}-\x{17f}0-9]+)"


class Remembered:
    """Values of words in a bounded memory of two generations: what a whole generation did not ask for is forgotten."""

    def __init__(self, bound: int, encode: Callable[[list[str]], list[bytes]]):
        self.bound, self.encode = bound, encode
        self.now: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def values(self, words: pa.Array) -> pa.Array:
        """The value of each word; words are distinct."""
        if len(self.now) > self.bound:
            self.now, self.old = {}, self.now
        now, old = self.now, self.old
        asked = words.to_numpy(zero_copy_only=False).tolist()  # several times faster than to_pylist()
        found = list(map(now.get, asked))
        holes = [k for k, v in enumerate(found) if v is None]
        if holes:
            missing = [asked[k] for k in holes]
            now.update({w: old[w] for w in missing if w in old})
            new = [w for w in missing if w not in now]
            now.update(zip(new, self.encode(new)))
            for k in holes:
                found[k] = now[asked[k]]
        return pa.array(found, pa.large_binary())


def joined_values(lists: pa.Array, encode: Callable[[pa.Array], pa.Array]) -> pa.Array:
    """The joined values of each list of words; ``encode`` gives the values of distinct words."""
    words = lists.flatten().dictionary_encode()
    each = encode(words.dictionary).take(words.indices)
    _, ends, data = each.buffers()
    ends = np.frombuffer(ends, np.int64)[lists.offsets.to_numpy()]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(ends), data])


class WordCoder:
    """Encodes texts by words between ASCII white space, remembering parts of words up to a bound.

    The tokenizer drops white space before its merges and no rule of it reaches over white
    space, so a text's ids are the ids of its words. Each distinct word of a batch is encoded once. Words of
    plain letters, digits and signs are cut to the tokenizer's own parts here, as parts recur more often than
    words; other words, and those with a special token, go through the whole tokenizer.
    """

    def __init__(self, path: str):
        # A task has one core, and the tokenizer shares a call out to threads unless told not to.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.merges = Tokenizer.from_file(path), Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 0xFF00:
            raise ValueError("ids over 65,279 are not supported")
        self.merges.normalizer = None
        self.merges.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        suffix = self.tokenizer.model.end_of_word_suffix
        self.last = np.zeros(0x10000, bool)
        if suffix:
            self.last[[i for piece, i in self.tokenizer.get_vocab().items() if piece.endswith(suffix)]] = True
        self.words = Remembered(GENERATION, self._whole)
        self.parts = Remembered(GENERATION, self._merged)

    def _whole(self, words: list[str]) -> list[bytes]:
        """Ids of each word by the whole tokenizer."""
        out: list[bytes] = []
        for at in range(0, len(words), TOGETHER):
            some = words[at : at + TOGETHER]
            found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            starts = np.cumsum([0] + [len(w) + 1 for w in some[:-1]])
            place = np.searchsorted(starts, np.array([o[0] for o in found.offsets], np.int64), "right") - 1
            out += _cut(found.ids, np.cumsum(np.bincount(place, minlength=len(some))))
        return out

    def _merged(self, parts: list[str]) -> list[bytes]:
        """Ids of each part by the merges alone; the last id of a part has the suffix that ends words."""
        out: list[bytes] = []
        for at in range(0, len(parts), TOGETHER):
            some = parts[at : at + TOGETHER]
            line = " ".join(some)
            ids = self.merges.encode_batch_fast([line], add_special_tokens=False)[0].ids
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(some):  # a tokenizer without the suffix, or one that drops unknown characters
                found = self.merges.encode(line, add_special_tokens=False)
                ids, place = found.ids, np.array(found.word_ids, np.int64)
                ends = np.cumsum(np.bincount(place, minlength=len(some)))
            out += _cut(ids, ends)
        return out

    def _encode(self, words: pa.Array) -> pa.Array:
        plain = pc.match_substring_regex(words, PLAIN)
        for token in self.special:
            plain = pc.and_not(plain, pc.match_substring(words, token))
        low = pc.utf8_lower(words.filter(plain))
        parts = pc.ascii_split_whitespace(pc.ascii_rtrim_whitespace(pc.replace_substring_regex(low, PARTS, r"\1 ")))
        found = [joined_values(parts, self.parts.values), self.words.values(words.filter(pc.invert(plain)))]
        here = plain.to_numpy(zero_copy_only=False)
        place = np.where(here, np.cumsum(here), len(low) + np.cumsum(~here)) - 1
        return pa.concat_arrays(found).take(pa.array(place))

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        words = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        found = joined_values(words, self._encode)
        _, ends, data = found.buffers()
        ids = np.frombuffer(data, "<u2")
        ends = (np.frombuffer(ends, np.int64) // 2).tolist()
        return [ids[a:b] for a, b in zip(ends, ends[1:])]


def _cut(ids: list[int], ends: np.ndarray) -> list[bytes]:
    data = np.array(ids, "<u2").tobytes()
    ends = (2 * ends).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends)]


_coders: dict[str, WordCoder] = {}


def word_coder(path: str) -> WordCoder:
    """One coder per worker process."""
    if path not in _coders:
        _coders[path] = WordCoder(path)
    return _coders[path]


@dataclass
class Example:
    """Tokens of one example from ``start`` on; tokens before ``prompt`` bear no loss."""

    key: int
    start: int
    stop: int
    prompt: int

    @property
    def demand(self) -> tuple[int, int, int]:
        """Tokens, segments and loss-bearing tokens."""
        return self.stop - self.start, 1, max(0, self.stop - max(self.start, self.prompt))


class VectorPacker:
    """Fills one sequence after the other from a window of candidates.

    A candidate that fits within all limits is scored by the dot product of its demand and the
    room left, each in units of the limit, with each dimension weighted by what the window
    demands of it; the highest score is placed, of equal ones the first. When nothing fits, the
    largest candidate is cut to fill the room, if examples may be cut; else the sequence is closed.
    """

    def __init__(self, tokens: int, segments: int, loss: int, cut: bool = True):
        self.limit = np.array([tokens, segments, loss], np.int64)
        self.cut = cut
        self.window: list[Example] = []

    def add(self, example: Example) -> list[list[Example]]:
        """The sequences that ``example`` fills alone; what is left of it joins the window."""
        full = []
        tokens, _, loss = self.limit.tolist()
        while example.stop > example.start:
            length, _, bears = example.demand
            if length < tokens and bears <= loss:
                self.window.append(example)
                break
            if not self.cut:
                if length > tokens or bears > loss:
                    raise ValueError(f"an example of {length} tokens, {bears} with loss, exceeds the limits")
                self.window.append(example)
                break
            stop = min(example.start + tokens, max(example.start, example.prompt) + loss, example.stop)
            full.append([Example(example.key, example.start, stop, example.prompt)])
            example = Example(example.key, stop, example.stop, example.prompt)
        return full

    def drain(self, leave: int = 0) -> list[list[Example]]:
        """Sequences made of the window, until at most ``leave`` candidates are left."""
        items = list(self.window)
        size, _, loss = (np.array(d, np.int64) for d in zip(*(e.demand for e in items))) if items else ((),) * 3
        here = np.ones(len(items), bool)
        left = len(items)
        tokens, segments, bearing = limit = self.limit.tolist()
        gone = max(limit) + 1  # the demand of a placed candidate, which never fits
        out = []
        while left > leave:
            room, number, bears = limit
            w_tokens, w_loss = (float(d[here].sum()) / most**3 for d, most in ((size, tokens), (loss, bearing)))
            w_number = left / segments**3
            sequence: list[Example] = []
            while left:
                fits = (size <= room) & (loss <= bears) if number else np.zeros(0, bool)
                if fits.any():
                    score = size * (w_tokens * room) + loss * (w_loss * bears) + w_number * number
                    k = int(np.where(fits, score, -1.0).argmax())
                    sequence.append(items[k])
                    room, number, bears = room - int(size[k]), number - 1, bears - int(loss[k])
                    here[k], size[k] = False, gone
                    left -= 1
                    continue
                k = int(np.where(here, size, -1).argmax())
                e = items[k]
                # Tokens that fit before the room for tokens or for loss ends.
                part = min(room, max(0, e.prompt - e.start) + bears)
                if not self.cut or number < 1 or part < MIN_PIECE or e.stop - e.start - part < MIN_PIECE:
                    break
                sequence.append(Example(e.key, e.start, e.start + part, e.prompt))
                items[k] = Example(e.key, e.start + part, e.stop, e.prompt)
                size[k], _, loss[k] = items[k].demand
                break
            out.append(sequence)
        self.window = [e for e, stays in zip(items, here) if stays]
        return out


def pack_documents(
    docs: DataFrame, path: str | None = None, max_tokens: int = 2048, max_segments: int = 128,
    max_loss: int | None = None, id_col: str = "doc_id", text_col: str = "text",
    prompt_col: str | None = None, cut: bool = True, with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    An example is the ids of its prompt, if there is a prompt column, of its text, and the end id;
    prompt tokens bear no loss. Sequences hold at most ``max_tokens`` tokens, ``max_segments``
    pieces and ``max_loss`` (default: ``max_tokens``) loss-bearing tokens. Examples are cut where
    that fills a sequence; with ``cut=False`` they stay whole and one beyond the limits is an error.
    ``with_ids`` adds the ids of each piece.

    Every task packs the rows of its input partition, with a window of ``CANDIDATES`` examples, so
    nothing is exchanged, no task holds more than its window and ``SLICE_CHARS`` characters of rows to
    encode, and only a task's last sequences are short. Null texts and prompts are empty: such an example is the end id alone. Ids may be
    null or repeated; repeated rows are packed as often. No rows give no rows. Other columns are
    not read.
    """
    path = path or public_tokenizers.path("word_bpe_49k.json")
    prompt = text_or_empty(prompt_col) if prompt_col else F.lit("")
    source = docs.select(
        F.col(id_col).alias("row_id"), prompt.alias("prompt"), text_or_empty(text_col).alias("body")
    )
    out = columns(start="long", length="long", ids_crc32="long", doc_tokens="long", sequence_id="long", offset="long")
    schema = StructType([source.schema["row_id"], *out.fields, *(columns(ids="longs").fields if with_ids else [])])
    limits = max_tokens, max_segments, max_tokens if max_loss is None else max_loss

    def make():
        use, packer = word_coder(path), VectorPacker(*limits, cut)
        first = TaskContext.get().partitionId() * IDS_PER_TASK
        held: dict[int, tuple] = {}  # examples that are not placed yet
        waiting: dict[int, int] = {}
        state = {"key": 0, "sequence": first, "chars": 0}
        slices: list[tuple] = []  # rows that are not encoded yet

        def rows(sequences):
            names = schema.fieldNames()
            given = {name: [] for name in names}
            for sequence in sequences:
                offset = 0
                for e in sequence:
                    row_id, ids = held[e.key]
                    piece = ids[e.start : e.stop]
                    values = (row_id, e.start, len(piece), zlib.crc32(piece.astype("<u4").tobytes()), len(ids), state["sequence"], offset)
                    for name, value in zip(names, values):
                        given[name].append(value)
                    if with_ids:
                        given["ids"].append(piece.astype(np.int64))
                    offset += len(piece)
                    waiting[e.key] -= len(piece)
                    if not waiting[e.key]:
                        del held[e.key], waiting[e.key]
                state["sequence"] += 1
            return given

        def pack():
            row_ids, prompts, texts = (list(chain.from_iterable(c)) for c in zip(*slices)) if slices else ((),) * 3
            slices.clear()
            state["chars"] = 0
            sequences = []
            found, before = use.encode_batch(texts), use.encode_batch(prompts)
            for row_id, lead, ids in zip(row_ids, before, found):
                key = state["key"] = state["key"] + 1
                ids = np.concatenate((lead, ids, np.array([END_ID], "<u2")))
                held[key], waiting[key] = (row_id, ids), len(ids)
                sequences += packer.add(Example(key, 0, len(ids), len(lead)))
                if len(packer.window) >= 2 * CANDIDATES:
                    sequences += packer.drain(CANDIDATES)
            return sequences

        def apply(row_ids, prompts, texts):
            slices.append((row_ids, prompts, texts))
            state["chars"] += sum(map(len, prompts)) + sum(map(len, texts))
            return rows(pack() if state["chars"] >= SLICE_CHARS else [])

        return apply, lambda: rows(pack() + packer.drain())

    return map_rows(source, schema, make).withColumnRenamed("row_id", id_col)
