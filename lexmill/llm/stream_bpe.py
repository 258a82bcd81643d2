"""Byte-pair encoding as a stream: tokens leave as soon as no later byte can change them."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from lexmill.llm.common import columns, map_rows, text_or_empty

END_OF_WORD = "</w>"
#: Bytes of a pre-token that gather beyond the lookahead before they are encoded.
GATHER = 4_096
#: Characters of a text that are read at a time.
READ = 1 << 16
#: Runs between white space of more characters are not remembered, and how many others are.
LONG_RUN = 128
REMEMBERED = 500_000
#: Bytes of a pre-token whose merges are found by scans instead of a heap.
SHORT = 24

# White space of the tokenizer's \s. str.split() splits at U+001C to U+001F as well.
WHITE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
SEPARATORS = re.compile("[\x1c-\x1f]")
#: Fixed value: the endings that are a pre-token of their own.
ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself, or the next free one from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in own}
    for b in range(256):
        letters.setdefault(b, chr(256 + b - sum(1 for x in own if x < b)))
    return [letters[b] for b in range(256)]


class Remembered(dict):
    """Values by key, made when missing; of two generations the older is forgotten, and long keys at once."""

    def __init__(self, make, bound: int, longest: int):
        self.make, self.half, self.longest, self.older = make, bound // 2, longest, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > self.longest:
                return value
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class MergeList:
    """Ranked merges over byte symbols; the last byte of a pre-token is a symbol of its own kind."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        letters = byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.last = [vocab[c + END_OF_WORD] for c in letters]
        self.size = max(vocab.values()) + 1
        self.width = [0] * self.size
        for i in self.inner + self.last:
            self.width[i] = 1
        #: rank by left and right token, and the token that the merge of a rank makes
        self.rank: list[dict[int, int]] = [{} for _ in range(self.size)]
        self.made: list[int] = []
        self.parts: list[tuple[int, int]] = []
        for a, b in merges:
            left, right, token = vocab[a], vocab[b], vocab[a + b]
            if not (self.width[left] and self.width[right]) or self.width[token]:
                raise ValueError("a merge must make a new token of two tokens that are made before it")
            self.rank[left][right] = len(self.made)
            self.made.append(token)
            self.parts.append((left, right))
            self.width[token] = self.width[left] + self.width[right]
        self.lookahead = self._lookahead()
        #: ids of whole pre-tokens as little-endian integers
        self.kind = "H" if self.size <= 1 << 16 else "I"
        self.ended = Remembered(lambda data: array(self.kind, self.encode(data, True)).tobytes(), REMEMBERED, SHORT)

    def _lookahead(self) -> int:
        """How far a byte can change token borders to its left, over all texts.

        Two texts that agree up to a border differ in the token behind it, if at all. Rank by rank,
        the border moves left by ``u`` when a merge ``(u, v)`` takes the token before it and the
        token ``v`` behind it in one text only; the tokens behind the border are then ``uv`` and
        ``u``. Between moves such a token may grow to the right. As ranks rise along the way, one
        pass over the merges from the last to the first finds the longest way for each token:
        ``far[t]`` is how far the border can still move with ``t`` behind it and only the merges seen so far.
        """
        far = [0] * self.size
        for (a, b), token in zip(reversed(self.parts), reversed(self.made)):
            move = self.width[a] + max(far[token], far[a])
            far[a] = max(far[a], far[token])
            far[b] = max(far[b], move)
        return max(far)

    def encode(self, data: bytes, ended: bool) -> list[int]:
        """The tokens of a buffer: lowest rank first, leftmost of equal ranks."""
        if not data:
            return []
        inner = self.inner
        token = [inner[b] for b in data]
        if ended:
            token[-1] = self.last[data[-1]]
        return self._short(token) if len(token) <= SHORT else self._long(token)

    def _short(self, token: list[int]) -> list[int]:
        rank, made, none = self.rank, self.made, len(self.made)
        ranks = [rank[a].get(b, none) for a, b in zip(token, token[1:])]
        while ranks and (r := min(ranks)) < none:
            i = ranks.index(r)
            token[i] = t = made[r]
            del token[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank[token[i - 1]].get(t, none)
            if i < len(ranks):
                ranks[i] = rank[t].get(token[i + 1], none)
        return token

    def _long(self, token: list[int]) -> list[int]:
        rank, n = self.rank, len(token)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            if (r := rank[token[i]].get(token[i + 1])) is not None:
                heap.append((r, i))
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if token[i] < 0 or j >= n or (token[i], token[j]) != self.parts[r]:
                continue  # one of the two is merged meanwhile
            token[i], token[j] = t, _ = self.made[r], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank[t].get(token[k])) is not None:
                    heapq.heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := rank[token[h]].get(t)) is not None:
                heapq.heappush(heap, (r, h))
        return [t for t in token if t >= 0]


class Transducer:
    """Bytes of one pre-token go in, tokens come out when they are stable.

    A token is stable when it ends more than the lookahead before the last byte read, whose own
    symbol is open until the next byte. At a border that stays, what follows is encoded as if it
    stood alone, so emitted bytes are forgotten: the buffer is bounded for pre-tokens of any length.
    """

    def __init__(self, merges: MergeList, gather: int = GATHER):
        self.merges = merges
        self.full = merges.lookahead + 1 + gather
        self.gather = gather
        self.buffer = bytearray()

    def push(self, data: bytes) -> list[int]:
        if len(self.buffer) + len(data) < self.full:
            self.buffer += data
            return []
        out: list[int] = []
        for at in range(0, len(data), self.gather):
            self.buffer += data[at : at + self.gather]
            if len(self.buffer) >= self.full:
                out += self._stable()
        return out

    def _stable(self) -> list[int]:
        tokens = self.merges.encode(bytes(self.buffer), False)
        limit = len(self.buffer) - 1 - self.merges.lookahead
        at = n = 0
        while n < len(tokens) and at + self.merges.width[tokens[n]] <= limit:
            at += self.merges.width[tokens[n]]
            n += 1
        del self.buffer[:at]
        return tokens[:n]

    def end(self) -> list[int]:
        tokens = self.merges.encode(bytes(self.buffer), True)
        self.buffer.clear()
        return tokens


class Decoder:
    """Ids go in, text comes out: spellings are joined, characters leave when their bytes are whole.

    Its state is whether a token came before and the at most three bytes of an open character.
    Bytes that are no character become U+FFFD.
    """

    def __init__(self, spelled: list[bytes], separator: bytes):
        self.spelled, self.separator = spelled, separator
        self.started = False
        self.open = b""

    def push(self, ids: list[int]) -> str:
        if not ids:
            return ""
        data = self.separator.join(map(self.spelled.__getitem__, ids))
        data = self.open + (self.separator if self.started else b"") + data
        self.started = True
        whole = len(data)
        for back in range(1, min(3, len(data)) + 1):  # an open character's lead is in the last three bytes
            b = data[-back]
            if b & 0xC0 != 0x80:
                if b >= 0xC0 and back < 2 + (b >= 0xE0) + (b >= 0xF0):
                    whole -= back
                break
        self.open = data[whole:]
        return data[:whole].decode("utf-8", "replace")

    def end(self) -> str:
        rest, self.open, self.started = self.open, b"", False
        return rest.decode("utf-8", "replace")


class Reader:
    """Text of one run without white space goes in piece by piece, ids come out.

    The text held back is what may still belong to a special token, to one normal form with the
    next character, or to an ending; of the pre-token in hand only the transducer's buffer is kept.
    Normal forms need all combining marks that follow a character, so a text of nothing but marks is held whole.
    """

    def __init__(self, coder: "StreamCoder"):
        self.coder = coder
        self.held = ""
        self.kind = None  # of the pre-token in hand
        self.transducer = Transducer(coder.merges, coder.gather)

    def feed(self, text: str) -> list[int]:
        self.held += text
        cut = self._cut(self.held)
        ready, self.held = self.held[:cut], self.held[cut:]
        return self._read(ready) if ready else []

    def end(self) -> list[int]:
        ids = self._read(self.held) if self.held else []
        self.held = ""
        return ids + self._close()

    def _close(self) -> list[int]:
        if self.kind is None:
            return []
        self.kind = None
        return self.transducer.end()

    def _cut(self, text: str) -> int:
        """The last place where what comes before does not depend on what comes after."""
        longest = self.coder.longest_special
        for p in range(len(text) - longest, 0, -1):
            if not _starts_anew(text[p]) or (text[p] != "'" and "'" in text[max(0, p - 3) : p]):
                continue
            around = self.coder.specials.finditer(text, max(0, p - longest), p + longest)
            if not any(m.start() < p < m.end() for m in around):
                return p
        return 0

    def _read(self, text: str) -> list[int]:
        out: list[int] = []
        at = 0
        for special in self.coder.specials.finditer(text):
            out += self._plain(text[at : special.start()])
            out += self._close()
            out.append(self.coder.special_ids[special.group()])
            at = special.end()
        return out + self._plain(text[at:])

    def _plain(self, text: str) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        text, push = self.coder.normal(text), self.transducer.push
        at = 0
        if self.kind:
            at = self.coder.more[self.kind].match(text).end()
            out += push(text[:at].encode())
            if at < len(text):
                out += self._close()
        for m in self.coder.pattern.finditer(text, at):
            out += push(m.group().encode())
            self.kind = m.lastgroup
            if m.end() < len(text) or self.kind not in self.coder.more:
                out += self._close()
        return out


def _starts_anew(c: str) -> bool:
    """Whether no normal form joins ``c`` to a character before it."""
    if c < "\u0300":
        return True
    return unicodedata.category(c)[0] in "LNPS" and not unicodedata.combining(c) and not "\u1100" <= c <= "\u11ff"


def _class(splitter, everything: str) -> str:
    """The members of a character class, as ranges of a pattern, as the tokenizer's own patterns see them."""
    kept = [ord(c) for piece, _ in splitter.pre_tokenize_str(everything) for c in piece]
    outside = np.ones(sys.maxunicode + 2, bool)
    outside[kept] = False
    outside[0xD800:0xE000] = outside[-1] = False
    edges = np.flatnonzero(np.diff(np.concatenate(([0], outside.view(np.int8), [0]))))
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in edges.reshape(-1, 2).tolist())


class StreamCoder:
    """Encoder and decoder for a tokenizer file with word ends, lower case and byte symbols.

    Normal forms, lower case and the letter and number classes are the library's own, character by
    character, as versions of Unicode differ; reading, merging and decoding are done here.
    """

    def __init__(self, path: str, gather: int = GATHER):
        from tokenizers import Regex, normalizers, pre_tokenizers

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        before = [p["type"] for p in spec["pre_tokenizer"]["pretokenizers"]]
        known = (
            steps == ["NFC", "Replace", "Lowercase"] and before == ["Split", "ByteLevel"]
            and model["end_of_word_suffix"] == END_OF_WORD and not model["dropout"] and not spec["post_processor"]
            and not spec["decoder"] and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
        )
        if not known:
            raise ValueError("the tokenizer file asks for steps that are not supported")
        self.special_ids = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.merges = MergeList(model["vocab"] | self.special_ids, [tuple(m) for m in model["merges"]])
        self.gather = gather
        names = sorted(self.special_ids, key=len, reverse=True)
        self.specials = re.compile("|".join(map(re.escape, names)) or "(?!)")
        self.longest_special = max(map(len, names), default=1)
        everything = "".join(map(chr, (*range(0xD800), *range(0xE000, sys.maxunicode + 1))))
        letters = _class(pre_tokenizers.Split(Regex(r"\p{L}"), "removed"), everything)
        numbers = _class(pre_tokenizers.Split(Regex(r"\p{N}"), "removed"), everything)
        other = rf"[^{WHITE.pattern[1:-2]}{letters}{numbers}]"
        self.pattern = re.compile(f"(?P<ending>{ENDINGS})|(?P<letters>[{letters}]+)|(?P<number>[{numbers}])|(?P<other>{other}+)")
        self.words = re.compile(f"{ENDINGS}|[{letters}]+|[{numbers}]|{other}+").findall
        self.more = {"letters": re.compile(f"[{letters}]*"), "other": re.compile(f"{other}*")}
        self._nfc, self._lower = normalizers.NFC().normalize_str, normalizers.Lowercase().normalize_str
        self.kind = self.merges.kind
        self.remembered = Remembered(self._run, REMEMBERED, LONG_RUN)
        #: what the library's decoder, which joins spellings by a space, writes; and the bytes meant
        tokens = sorted({**model["vocab"], **self.special_ids}.items(), key=lambda t: t[1])
        at = {c: b for b, c in enumerate(byte_letters())}
        self.spelled, self.meant = [b""] * self.merges.size, [b""] * self.merges.size
        for token, i in tokens:
            self.spelled[i] = token.encode()
            ended = token.endswith(END_OF_WORD)
            raw = token.removesuffix(END_OF_WORD)
            self.meant[i] = token.encode() if token in self.special_ids else bytes(at[c] for c in raw) + b" " * ended

    def normal(self, text: str) -> str:
        """Normal form and lower case; below U+0300 there is nothing to join."""
        return text.lower() if not text or max(text) < "\u0300" else self._lower(self._nfc(text))

    def _run(self, run: str) -> bytes:
        """The ids of one run; a short one has no token that is stable before its end."""
        if len(run) > LONG_RUN or self.specials.search(run):
            reader = Reader(self)
            return array(self.kind, reader.feed(run) + reader.end()).tobytes()
        return b"".join([self.merges.ended[w.encode()] for w in self.words(self.normal(run))])

    def _runs(self, text: str) -> list[str]:
        return [r for r in WHITE.split(text) if r] if SEPARATORS.search(text) else text.split()

    def encode_blocks(self, text: str) -> Iterator[bytes]:
        """The ids of a text as little-endian integers, block by block.

        Runs between white space do not touch each other's tokens; short ones are remembered, and
        one that is longer than a block goes through a reader.
        """
        at, n, remembered = 0, len(text), self.remembered.__getitem__
        while at < n:
            block = text[at : at + READ]
            at += len(block)
            runs = self._runs(block)
            if at < n and not WHITE.match(block[-1]) and runs:
                open_run = runs.pop()
                if len(open_run) < READ:
                    at -= len(open_run)  # read again with what follows
                else:
                    yield from self._long_run(text, at - len(open_run))
                    end = WHITE.search(text, at)
                    at = end.start() if end else n
                    continue
            yield b"".join(map(remembered, runs))

    def _long_run(self, text: str, at: int) -> Iterator[bytes]:
        reader, end = Reader(self), None
        while at < len(text) and end is None:
            end = WHITE.search(text, at, at + READ)
            piece = text[at : end.start() if end else at + READ]
            yield array(self.kind, reader.feed(piece)).tobytes()
            at += len(piece)
        yield array(self.kind, reader.end()).tobytes()

    def decoder(self, spelled: bool = True) -> Decoder:
        """A decoder to the library's spelling, or to the text meant, whose words end with a space."""
        return Decoder(self.spelled, b" ") if spelled else Decoder(self.meant, b"")


_coders: dict[tuple[str, int], StreamCoder] = {}


def coder(path: str, gather: int = GATHER) -> StreamCoder:
    """One coder per worker process; tables are built from the file where the task runs."""
    if (path, gather) not in _coders:
        _coders[path, gather] = StreamCoder(path, gather)
    return _coders[path, gather]


def encode_documents(
    docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
    decode: str | None = None,
) -> DataFrame:
    """One row per input row: ``id_col, ids`` and, with ``decode`` ``"spelled"`` or ``"meant"``, ``decoded``.

    Ids are those of the tokenizer library without added special tokens; special tokens that a text
    holds are encoded as such. ``spelled`` is the library's decoding with special tokens kept,
    ``meant`` the lower-cased text with one space after each pre-token.

    A null text is the empty text and has no ids; ids of rows may be null or repeated, repeated
    rows stay. Whole texts are encoded; beside the text and its ids memory holds a block of it, a buffer of
    the lookahead and the remembered runs. No rows give no rows. Other columns are not read. The
    tokenizer file must be at the same path on every machine.
    """
    return _mapped(docs, path, id_col, text_col, decode, False)


def token_digests(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256`` of ``encode_documents``, summed up block by block:
    ids as little-endian unsigned 32-bit integers, and the spelled decoding in UTF-8."""
    return _mapped(docs, path, id_col, text_col, None, True)


def _mapped(docs, path, id_col, text_col, decode, digests):
    path = path or public_tokenizers.path("word_bpe_49k.json")
    source = docs.select(F.col(id_col).alias("row_id"), text_or_empty(text_col).alias("body"))
    if digests:
        out = columns(n_tokens="long", ids_sha256="string", decoded_sha256="string")
    else:
        out = columns(ids="longs", decoded="string") if decode else columns(ids="longs")
    schema = StructType([source.schema["row_id"], *out.fields])

    def make():
        use = coder(path)

        def digest(text):
            n, ids_sum, text_sum, back = 0, hashlib.sha256(), hashlib.sha256(), use.decoder()
            for block in use.encode_blocks(text):
                ids = np.frombuffer(block, use.kind)
                n += len(ids)
                ids_sum.update(ids.astype("<u4"))
                text_sum.update(back.push(ids.tolist()).encode())
            text_sum.update(back.end().encode())
            return n, ids_sum.hexdigest(), text_sum.hexdigest()

        def whole(text):
            blocks = [np.frombuffer(b, use.kind) for b in use.encode_blocks(text)]
            ids = np.concatenate([np.zeros(0, use.kind), *blocks]).astype(np.int64)
            if not decode:
                return (ids,)
            back = use.decoder(decode == "spelled")
            return ids, "".join([back.push(b.tolist()) for b in blocks]) + back.end()

        def apply(rows, texts):
            found = [digest(t) if digests else whole(t) for t in texts]
            return {"row_id": rows} | {name: [f[k] for f in found] for k, name in enumerate(out.fieldNames())}

        return apply

    return map_rows(source, schema, make).withColumnRenamed("row_id", id_col)
