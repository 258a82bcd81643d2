"""Fill-in-the-middle, streamed byte-pair encoding and spelling variants against plain versions."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
from lexmill.llm import infill, spelling, stream_bpe
from tests.llm.test_documents import frame

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_rotation_in_blocks(monkeypatch):
    rng = random.Random(1)
    for block in (1, 2, 3, 1 << 16):
        monkeypatch.setattr(infill, "BLOCK", block)
        for _ in range(200):
            data = bytes(rng.randrange(256) for _ in range(rng.randrange(20)))
            a, b, c = sorted(rng.randrange(len(data) + 1) for _ in range(3))
            buffer = bytearray(data)
            infill.rotate(buffer, a, b, c)
            assert buffer == data[:a] + data[b:c] + data[a:b] + data[c:]
            text = "".join(rng.choice("aé日😀<>SPM") for _ in range(rng.randrange(12)))
            i, j = sorted(rng.randrange(len(text) + 1) for _ in range(2))
            assert infill.byte_offsets(text.encode(), (i, j)) == [len(text[:i].encode()), len(text[:j].encode())]


def plain_infill(row_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if row_id is None else row_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_infill_equals_plain_version(spark):
    rng = random.Random(2)
    rows = [(k, "".join(rng.choice(["a", "é", "日", "😀", " ", "<", "P>", "<S", "M>", "\n", "́"]) for _ in range(rng.randrange(40)))) for k in range(300)]
    rows += [(1000, None), (1001, ""), (None, "no id"), (1002, "x<M>y"), (1003, "é" * 200_000), (7, rows[7][1]), (1004, "<")]
    got = infill.fill_in_middle(frame(spark, rows).repartition(3))
    got = got.withColumn("back", infill.restored(F.col("output"), F.col("form")).cast("string")).withColumn("output", F.col("output").cast("string"))
    seen = collections.Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in got.collect())
    assert seen == collections.Counter((i, *plain_infill(i, t), t or "") for i, t in rows)
    assert {k[2] for k in seen} == {"plain", "psm", "spm"}
    assert infill.fill_in_middle(frame(spark, rows).limit(0)).count() == 0


def test_infill_with_clashing_columns(spark):
    docs = frame(spark, [(1, "some text")]).selectExpr("doc_id", "text", "1 as n", "2 as form", "3 as output", "4 as __text")
    row = infill.fill_in_middle(docs).first()
    assert row.output.decode() == plain_infill(1, "some text")[4]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(coder, text):
    return np.frombuffer(b"".join(coder.encode_blocks(text)), coder.kind).tolist()


MIXED = ["a", "b", "ab", "the", "'", "'s", "'r", "'re", "'ll", " ", "!", "=", "Σ", "É", "É", "́", "̧", "日", "가",
         "각", "ᆨ", "1", "²", "\x85", "\x1c", "　", "<|endoftext|>", "<|startoftext|>", "<|", "|>", "İ", "ſ",
         "K", "क़", "😀", "\U00010d50", "ா", "கெ", "Ɤ", "<", " ", "ﷺ"]


def test_stream_equals_library(library, monkeypatch):
    """Tiny blocks and buffers, so that every state of the reader and the transducer is met."""
    monkeypatch.setattr(stream_bpe, "READ", 48)
    coder = stream_bpe.StreamCoder(PATH, gather=5)
    rng = random.Random(3)
    for _ in range(600):
        pool = rng.choice([MIXED, MIXED[:4], MIXED[4:9] + ["r", "e", "S"], [c for c in MIXED if not c.isspace()]])
        text = "".join(rng.choice(pool) for _ in range(rng.choice([2, 30, 500])))
        assert ids_of(coder, text) == library.encode(text, add_special_tokens=False).ids, text


def test_transducer_keeps_a_bounded_buffer(library):
    coder = stream_bpe.StreamCoder(PATH)
    merges = coder.merges
    assert 32 <= merges.lookahead <= 1024
    rng = random.Random(4)
    text = "".join(rng.choice("etaoinshrdlu") for _ in range(200_000)).encode()
    one, out, most = stream_bpe.Transducer(merges), [], 0
    for at in range(0, len(text), 999):
        out += one.push(text[at : at + 999])
        most = max(most, len(one.buffer))
    assert most <= merges.lookahead + 1 + 2 * stream_bpe.GATHER
    assert len(out) > 10_000  # most tokens left before the end
    assert out + one.end() == library.encode(text.decode(), add_special_tokens=False).ids


def test_lookahead_bounds_every_change():
    """On small merge lists, no ending changes a token further back than the lookahead says."""
    rng = random.Random(5)
    letters = stream_bpe.byte_letters()
    for _ in range(30):
        vocab = {c: k for k, c in enumerate(letters)} | {c + "</w>": 256 + k for k, c in enumerate(letters)}
        merges = []
        made = ["a", "b", "c", "c</w>"]
        while len(merges) < 25:
            left, right = rng.choice([t for t in made if "<" not in t]), rng.choice(made)
            if left + right not in vocab:
                vocab[left + right] = len(vocab)
                merges.append((left, right))
                made.append(left + right)
        use = stream_bpe.MergeList(vocab, merges)
        for _ in range(60):
            start = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 60)))
            texts = [(start + "".join(rng.choice("abc") for _ in range(rng.randrange(0, 9)))).encode() for _ in range(2)]
            borders = []
            for data in texts:
                ends, at = [], 0
                for token in use.encode(data, True):
                    at += use.width[token]
                    ends.append((at, token))
                borders.append([e for e in ends if e[0] <= len(start) - 1 - use.lookahead])
            assert borders[0] == borders[1]
            short = stream_bpe.Transducer(use, gather=1)
            assert [t for b in texts[0] for t in short.push(bytes([b]))] + short.end() == use.encode(texts[0], True)
    with pytest.raises(ValueError):
        stream_bpe.MergeList(vocab | {"x": 1}, [*merges, merges[0]])


def test_decoder_states(library):
    coder = stream_bpe.StreamCoder(PATH)
    rng = random.Random(6)
    for _ in range(200):
        ids = [rng.randrange(49_408) for _ in range(rng.randrange(1, 40))]
        whole = b"".join(coder.meant[i] for i in ids).decode("utf-8", "replace")
        for spelled, wanted in ((True, library.decode(ids, skip_special_tokens=False)), (False, whole)):
            back, out, at = coder.decoder(spelled), "", 0
            while at < len(ids):
                step = rng.randrange(0, 4)
                out += back.push(ids[at : at + step])
                assert len(back.open) <= 3
                at += step
            assert out + back.end() == wanted
    assert "".join(stream_bpe.StreamCoder(PATH).decoder(False).push(ids_of(coder, "Über  日本 x2!"))) == "über 日本 x 2 ! "


def test_stream_tables(spark, library):
    rows = [(k, t) for k, t in enumerate(["Hello World", "", None, "don't <|endoftext|>stop", "x" * 100_000 + "é" * 70_000 + " end", "a b"])]
    rows += [(5, "a b"), (None, "null id"), (8, " \n\t")]
    docs = frame(spark, rows).selectExpr("doc_id", "text", "1 as ids", "2 as body", "3 as row_id").repartition(2)
    got = stream_bpe.token_digests(docs).collect()
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        spelled = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(spelled.encode()).hexdigest()))
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)
    full = {r.doc_id: r for r in stream_bpe.encode_documents(docs, decode="meant").collect()}
    assert full[0].decoded == "hello world " and full[2].ids == []
    assert stream_bpe.token_digests(docs.limit(0)).count() == 0


def plain_variants(rows, ratio=5):
    """Counts, near words by trying every edit, forms and roots."""
    counts = collections.Counter()
    for row_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if row_id is None else row_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    letters = set("".join(counts))
    near = {}
    for w in counts:
        edits = {w[:i] + w[i + 1 :] for i in range(len(w))}
        edits |= {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in letters}
        edits |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        near[w] = sorted((edits - {w}) & set(counts), key=lambda v: (-counts[v], v))
    form = {w: v[0] if v and counts[v[0]] >= ratio * counts[w] else None for w, v in near.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] else None) for w, n in counts.items()}


def variant_rows(seed, words=150):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abé×") for _ in range(rng.randrange(6, 10))) for _ in range(words // 3)]
    base += ["aaaaaa", "aaaaaaa", "aaaaaaaa", "a" * 300, "a" * 301, "Ab" * 40]
    pool = []
    for w in base:
        pool += [w.upper() if rng.random() < 0.3 and w.isascii() else w] * rng.choice([1, 5, 30, 160, 900])
        for _ in range(3):
            i = rng.randrange(len(w))
            pool += [rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abc") + w[i:], w[:i] + "b" + w[i + 1 :]])] * rng.choice([3, 5, 6, 30])
    rng.shuffle(pool)
    rows = [(k, " ".join(pool[k * 40 : k * 40 + 40])) for k in range(len(pool) // 40 + 1)]
    return rows + [(None, "null ids count, lovely " * 9), (9000, None), (9001, ""), rows[0], rows[0]]


@pytest.mark.parametrize("indexed", [2, 7, spelling.INDEXED])
def test_variants_equal_plain_version(spark, indexed):
    """Buckets of two words are divided to the end, large ones not at all; both give the same."""
    rows = variant_rows(indexed % 3)
    docs = frame(spark, rows).selectExpr("doc_id", "text", "1 as word", "2 as n", "3 as id").repartition(3)
    got = {tuple(r) for r in spelling.spelling_variants(docs, indexed=indexed).collect()}
    want = plain_variants(rows)
    assert got == want
    assert sum(1 for w in want if w[1]) > 10


def test_bitsets_equal_edit_distance():
    rng = random.Random(8)
    for _ in range(200):
        words = list({"".join(rng.choice("ab") for _ in range(rng.randrange(1, 8))) for _ in range(30)})
        index = spelling.PositionIndex(words)
        for k, word in enumerate(words):
            edits = {word[:i] + word[i + 1 :] for i in range(len(word))}
            edits |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in "ab"}
            edits |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in "ab"}
            found = index.near(word, 1 << k, 0)
            assert {w for j, w in enumerate(words) if found >> j & 1} == (edits - {word}) & set(words)


def test_no_words(spark):
    docs = frame(spark, [(1, None), (2, "one two")])
    assert spelling.spelling_variants(docs).count() == 0
    assert spelling.spelling_variants(docs.limit(0)).count() == 0


def test_queries_on_whole_tables(spark, library, small_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()]
    named = __spark_entry__.queries()
    got = {tuple(r) for r in named["op13_spelling_index"](spark, small_dir).collect()}
    assert got == plain_variants(docs)
    ids = {r.doc_id: r.ids_sha256 for r in named["op12_stream_transducer"](spark, small_dir).collect()}
    for i, t in docs:
        want = np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes()
        assert ids[i] == hashlib.sha256(want).hexdigest()
    rows = {r.doc_id: r for r in named["op11_block_rotation"](spark, small_dir).collect()}
    for i, t in docs:
        n, form, prefix, middle, output = plain_infill(i, t)
        assert tuple(rows[i])[1:6] == (n, form, prefix, middle, hashlib.sha256(output.encode()).hexdigest())
        assert rows[i].restored_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
