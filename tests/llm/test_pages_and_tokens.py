"""Extraction, archives, byte-pair encoding and packing; the pipeline against a plain version."""

from __future__ import annotations

import base64
import collections
import hashlib
import json
import random
import zlib

import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from lexmill.llm import byte_bpe, extraction, jaccard_join, packing, private_data, quality, warc
from tests.llm.test_documents import EDGE, frame

PAGES = "page_id bigint, url string, html string, host string, path string, text string, digest string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "a", "b", "c", "d") for i, u, h in rows], PAGES).repartition(3)


def article(k):
    return (
        f"<html><body class='p{k}'><header><h2>Site</h2></header><nav><ul><li><a href='/'>Home</a></ul></nav>"
        f"<div class='cookie-notice'>We use cookies {k}</div><div class='content c{k}'><h1>Head &amp; {k}</h1>"
        f"<p>First <b>bold</b>\n text&nbsp;here {'long ' * 20}<p>Second<br>line</p><script>var a = '<p>no</p>';</script>"
        f"<ul><li>one<li>two</ul></div><aside>side</aside><form>q<input></form>"
        f"<div id='comments'><p>{'nice post ' * 30}</p></div><footer>foot</footer>"
    )


def wanted(k):
    return f"Head & {k}\nFirst bold text here {'long ' * 20}".strip() + "\nSecond line\none\ntwo"


def test_main_text(spark):
    rows = [(k, f"https://u@Host.com:80/{k}?x=1", article(k)) for k in range(6)]
    rows += [(10, "http://host.com/s", "<body><div class='content c9'>tiny</div><article><p>" + "real words " * 20 + "</article>")]
    rows += [(11, None, None), (12, "", ""), (13, "x", "plain text only"), (0, "https://host.com/0", article(0)), (None, "h", "<p>a<p>b")]
    rows += [(14, "http://big.com", "<article>" + "<p>word</p>" * 30_000 + "</article>"), (15, "http://bad.com", "<div <p a='>x</b> < 5 <3 &lt;p&gt;<!-- open")]
    got = extraction.extract_main_text(pages(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    for k in range(6):
        assert by[k].text == wanted(k)
        assert by[k].path.endswith("div.c#.content")
    assert by[10].text == ("real words " * 20).strip()
    assert (by[11].text, by[12].text, by[13].text, by[None].text) == ("", "", "plain text only", "a\nb")
    assert by[14].text == "\n".join(["word"] * 30_000)
    assert extraction.extract_main_text(pages(spark, rows).limit(0)).count() == 0


def test_hosts_with_two_layouts(spark):
    word = lambda n: "<p>" + "word " * n + "</p>"
    lines = lambda *n: "\n".join(("word " * k).strip() for k in n)
    rows = [(k, "http://h.com", f"<main><article>{word(200)}</article></main>") for k in range(20)]
    rows += [(30, "http://h.com", f"<main>{word(70)}<article>{word(120)}</article>{word(10)}</main>")]
    rows += [(31, "http://h.com", f"<main><article>{word(120)}</article><p><a href=x>more to read</a></p></main>")]
    rows += [(32, "http://h.com", f"<main><article>{word(30)}</article><div class='content'>{word(90)}</div></main>")]
    rows += [(40 + k, "http://d.com", f"<div><div class='content'>{word(100)}</div></div>") for k in range(9)]
    rows += [(60, "http://d.com", f"<div>{word(45)}<div class='content'>{word(55)}</div></div>")]
    rows += [(61, "http://d.com", "<div><p><a href=x>only links</a></p></div>")]
    got = {r.page_id: r for r in extraction.extract_main_text(pages(spark, rows)).collect()}
    assert (got[30].path, got[60].path) == ("main>article", "div>div.content")
    assert {got[k].text for k in range(20)} == {lines(200)} and got[31].text == lines(120)
    assert (got[30].text, got[32].text, got[60].text) == (lines(70, 120, 10), lines(30, 90), lines(45, 55))
    assert got[61].text == "only links"


@pytest.mark.parametrize("quote", ["'", '"'])
@pytest.mark.parametrize("n", [1, 17, 1000, 200_000])
def test_signs_in_quoted_values(quote, n):
    value = ("</div><p hidden class=ad>x<script>" * n)[: 40 * n]
    page = extraction.Page(f"<div data-x = {quote}{value}{quote} class='content'><p title=it's>one</p>two</div>three")
    assert [text for text, *_ in page.blocks] == ["one", "two", "three"]
    assert [c[0] for c in page.containers] == ["div.content"]


def test_torn_tags_end_at_the_first_sign():
    texts = lambda html: [text for text, *_ in extraction.Page(html).blocks]
    assert texts("<p class='a>one</p><div>two</div>") == ["one", "two"]
    assert texts('<p a="x>one</p>' + "<p>two</p>" * 3) == ["one", "two", "two", "two"]
    assert len(texts('<p a=">" ' * 200_000)) == 200_000  # in linear time
    assert texts("<div data-class='ad' alt='hidden'>one</div><div CLASS=ad>two</div>") == ["one"]


def test_hosts_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(extraction, "BROADCAST_HOSTS", 0)
    got = extraction.extract_main_text(pages(spark, [(k, "http://h.com", article(k)) for k in range(5)]))
    assert {r.page_id: r.text for r in got.collect()} == {k: wanted(k) for k in range(5)}


WEB = [(1, "http://a/1", "same"), (2, "http://a/2", "same"), (3, "http://a/3", "other\r\n\r\nWARC/1.1\r\n\r\n"), (4, None, None),
       (5, "x\r\ny", ""), (6, "http://ü/6", "ü€"), (2, "http://a/2", "same"), (None, "http://n", "same"), (7, "u", "x" * 300_000)]


@pytest.mark.parametrize("least,codec", [(0, "none"), (5, "gzip")])
def test_archives_round_trip(spark, tmp_path, least, codec):
    path = str(tmp_path / "a")
    warc.write_archive(warc.with_revisits(pages(spark, WEB), min_bytes=least), path, codec=codec)
    records = warc.read_archive(spark, path).cache()
    assert records.count() == 3 * len(WEB)
    captures = warc.assemble(records).collect()
    assert len(captures) == len(WEB)
    first: dict[str, int] = {}
    for i, _, h in sorted(WEB, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(h or "", i)
    want = collections.Counter()
    for i, _, h in WEB:
        data = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        again = len(data) >= least and (first[h or ""] != i or want[(i, digest, "response", data, None)] > 0)
        want[(i, digest, "revisit" if again else "response", b"" if again else data, first[h or ""] if again else None)] += 1
    got = collections.Counter()
    for c in captures:
        about = {f.name: f.value for f in c.metadata[0].fields}
        number = lambda n: int(about[n]) if n in about else None
        assert c.request is not None and len(c.metadata) == 1
        assert c.response.http_length == len((dict((i, h) for i, _, h in WEB)[number("pageid")] or "").encode())
        got[(number("pageid"), c.response.payload_digest, c.response.warc_type, bytes(c.response.payload), number("referstopageid"))] += 1
    assert got == want


def test_links_in_any_direction(spark):
    rows = [("response", "A", "B", 1), ("request", "B", None, 2), ("metadata", "C", "B", 3), ("response", "D", None, 4),
            ("request", "E", "D", 5), ("metadata", "F", "E", 6), ("metadata", "G", "nowhere", 7), ("request", "H", None, 8), ("resource", "I", None, 9)]
    got = warc.assemble(spark.createDataFrame(rows, "warc_type string, record_id string, concurrent_to string, v int"))
    assert sorted((c.response.v, c.request and c.request.v, [m.v for m in c.metadata]) for c in got.collect()) == [
        (1, 2, [3]), (4, 5, [6]), (9, None, [])]


def test_damaged_archives_fail():
    with pytest.raises(ValueError):
        list(warc.parse_records(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"))
    with pytest.raises(ValueError):
        list(warc.parse_records(b"not an archive"))


@pytest.fixture(scope="module")
def bytes_coder():
    return byte_bpe.TextCoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def test_rank_queue():
    rng, queue, held = random.Random(1), byte_bpe.RankQueue(50_000, ordered=True), []
    for _ in range(3000):
        if held and rng.random() < 0.5:
            assert queue.lowest() == min(held)[0]
            assert queue.pop(min(held)[0]) == min(held)[1]
            held.remove(min(held))
        else:
            entry = rng.randrange(50_000), rng.randrange(100)
            held.append(entry)
            queue.push(*entry)
    assert byte_bpe.RankQueue(10).lowest() == -1


def test_byte_ids_equal_the_library(spark, bytes_coder):
    bpe, rng = bytes_coder.bpe, random.Random(2)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    texts = ["".join(rng.choice(["a", "b", "the", "ing", " ", "é", "日", "🙂", "1", ".", "\n", "'s"]) for _ in range(rng.randint(0, 90))) for _ in range(600)]
    texts += ["a" * 3000, "ab" * 900, "<|endoftext|> x", "", "​\x00"]
    for text, ids in zip(texts, bytes_coder.encode_batch(texts)):
        assert ids.tolist() == plain.encode_ordinary(text)
        assert bpe.decode(ids.tolist()) == text.encode()
        for piece in bytes_coder.split(text):
            assert bpe.encode_long(piece.encode()) == bpe.encode_short([piece.encode()])[0].tolist()
    rows = [*EDGE, (50, "z" * 20_000)]
    got = byte_bpe.token_digests(frame(spark, rows)).collect()
    want = collections.Counter()
    for i, t in rows:
        ids = plain.encode_ordinary(t or "")
        want[(i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())] += 1
    assert collections.Counter(map(tuple, got)) == want
    full = byte_bpe.encode_documents(frame(spark, rows), decode=True)
    assert all(bytes(r.decoded).decode() == "".join(map(str, [bpe.decode(r.ids).decode()])) for r in full.collect())
    assert byte_bpe.token_digests(frame(spark, rows).limit(0)).count() == 0


def test_remembered_words_are_bounded(bytes_coder, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 3)
    small = byte_bpe.TextCoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    texts = ["one two three four five six", "six seven one"]
    assert [a.tolist() for a in small.encode_batch(texts)] == [a.tolist() for a in bytes_coder.encode_batch(texts)]
    assert len(small.known) <= 3


PACKED = [*EDGE, *[(100 + k, "word and more, " * (k % 37)) for k in range(150)], (400, "x1 \x1c　y <|endoftext|> ΑΣ İ é")]


@pytest.mark.parametrize("limits", [(64, 4, 40), (128, 100, 128)])
def test_packing_keeps_limits_and_tokens(spark, limits):
    tokens, segments, loss = limits
    got = packing.pack_documents(
        frame(spark, PACKED), max_tokens=tokens, max_segments=segments, max_loss=loss, prompt_col="id", with_ids=True)
    rows = got.collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lead = library.encode("x", add_special_tokens=False).ids
    want = collections.Counter()
    for i, t in PACKED:
        want[i, tuple(lead + library.encode(t or "", add_special_tokens=False).ids + [1])] += 1
    sequences = collections.defaultdict(list)
    for r in rows:
        assert len(r.ids) == r.length and zlib.crc32(b"".join(i.to_bytes(4, "little") for i in r.ids)) == r.ids_crc32
        sequences[r.sequence_id].append(r)
    used = 0
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= tokens and len(pieces) <= segments
        assert sum(p.length - max(0, min(p.length, len(lead) - p.start)) for p in pieces) <= loss
        used += at
    assert used == sum(len(ids) * n for (_, ids), n in want.items())
    by_doc = collections.defaultdict(list)
    unique = {i for (i, _), n in want.items() if n == 1 and sum(a == i for a, _ in want) == 1}
    for r in rows:
        if r.doc_id in unique:
            by_doc[r.doc_id].append((r.start, r.ids))
    for (i, ids), _ in want.items():
        if i in unique:
            assert [x for _, piece in sorted(by_doc[i]) for x in piece] == list(ids)
    assert packing.pack_documents(frame(spark, PACKED).limit(0)).count() == 0


def test_whole_examples():
    packer = packing.VectorPacker(10, 3, 6, cut=False)
    items = [packing.Example(k, 0, n, p) for k, (n, p) in enumerate([(9, 4), (5, 2), (5, 2), (1, 0), (10, 8), (2, 0)])]
    for e in items:
        assert packer.add(e) == []
    out = packer.drain()
    assert sorted(e.key for s in out for e in s) == list(range(6))
    for s in out:
        assert (sum(e.demand[0] for e in s), len(s)) <= (10, 3) and sum(e.demand[2] for e in s) <= 6
    with pytest.raises(ValueError):
        packer.add(packing.Example(9, 0, 11, 11))


def test_production_packing_has_little_padding(spark, small_dir):
    rows = packing.pack_documents(spark.read.parquet(f"{small_dir}/documents.parquet")).collect()
    sums = collections.Counter()
    for r in rows:
        sums[r.sequence_id] += r.length
    assert max(sums.values()) <= 2048 and sum(sums.values()) > 0.97 * 2048 * len(sums)


def test_pipeline_equals_plain_stages(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    left = docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = spark.createDataFrame(stage(spark, left, small_dir).collect(), docs.schema)
        assert left.columns == docs.columns
        kept[name] = {r.doc_id: r.text for r in left.collect()}
    toxic = frozenset(w.encode() for w in quality.TOXIC_WORDS)
    plain = {}
    for r in docs.collect():
        m = dict(zip(quality.MEASURES.fieldNames(), quality.measure(r.text, toxic)))
        if not any(eval(rule.fails, {}, m) for rule in quality.RULES):
            plain[r.doc_id] = r.text
    assert kept["quality rules"] == plain
    last = {t: i for i, t in sorted(plain.items())}
    plain = {i: t for t, i in last.items()}
    assert kept["exact dedup"] == plain
    sets = {i: set(jaccard_join.shingles(t).tolist()) for i, t in plain.items()}
    group = {i: i for i in sorted(plain)}
    for i in sorted(plain):
        for j in sorted(plain):
            if i < j and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                a, b = sorted((group[i], group[j]))
                group = {k: a if g == b else g for k, g in group.items()}
    plain = {i: t for i, t in plain.items() if group[i] == i}
    assert kept["n-gram Jaccard join"] == plain
    for i, t in plain.items():
        if not private_data.HINT.search(t):
            assert kept["PII"][i] == t
        assert not private_data.base_spans(kept["PII"][i])
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = collections.Counter()
    for r in corpus_pipeline.run(spark, small_dir).collect():
        pieces[r.doc_id] += r.length
    assert pieces == {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in kept["PII"].items()}


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
    assert "pipeline" in names and set(__spark_entry__.oracle_sql()) <= set(names)


@pytest.mark.parametrize("seed", range(6))
def test_the_heuristic_places_the_largest_product(seed):
    rng = random.Random(seed)
    limit = (40, rng.choice([3, 100]), rng.choice([15, 40]))
    items = [packing.Example(k, 0, n, rng.randint(0, n)) for k in range(60) for n in (rng.randint(1, 14),)]
    packer = packing.VectorPacker(*limit, cut=False)
    for e in items:
        assert packer.add(e) == []
    left, want = list(items), []
    while left:
        room, sequence = list(limit), []
        weight = [sum(e.demand[d] for e in left) / limit[d] ** 2 for d in range(3)]
        while fits := [e for e in left if all(n <= r for n, r in zip(e.demand, room))]:
            score = lambda e: round(sum(n * w * r / m for n, w, r, m in zip(e.demand, weight, room, limit)), 9)
            best = max(fits, key=lambda e: (score(e), -e.key))
            sequence.append(best.key)
            room = [r - n for r, n in zip(room, best.demand)]
            left.remove(best)
        want.append(sequence)
    assert [[e.key for e in s] for s in packer.drain()] == want


def test_word_memory_forgets_and_stays_exact(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    monkeypatch.setattr(packing, "GENERATION", 5)
    coder, rng = packing.WordCoder(path), random.Random(3)
    signs = ["a", "Word", "ÉTÉ", "ſ", "İ", "ŉ", "ß", "÷", "×", "'s", "'RE", "9", "x²", "µ", "日", "é", "\x00", "\x7f", "<|endoftext|>", "(", "--", "Ÿ", "ǅ"]
    for _ in range(40):
        texts = ["".join(rng.choice([*signs, " ", "\n", "　", "\x1c"]) for _ in range(rng.randint(0, 60))) for _ in range(8)]
        assert [a.tolist() for a in coder.encode_batch(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(coder.words.old) <= 8 * 60


def test_words_are_looked_up_once_a_batch():
    class Counted(dict):
        asked = 0

        def get(self, *key):
            self.asked += 1
            return super().get(*key)

    coder = packing.WordCoder(public_tokenizers.path("word_bpe_49k.json"))
    coder.words.now, coder.parts.now = Counted(), Counted()
    texts = ["Plain words, and 日本 more; " * 500] * 20
    assert len({a.tobytes() for a in coder.encode_batch(texts)}) == 1
    assert coder.words.now.asked + coder.parts.now.asked <= 10


@pytest.mark.parametrize("suffix", ["</w>", None])
def test_words_of_every_letter(monkeypatch, tmp_path, suffix):
    """Letters, marks and white space of the basic plane, also for a tokenizer without ends of words."""
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        made = json.load(f)
    made["model"]["end_of_word_suffix"] = suffix
    path = tmp_path / "made.json"
    path.write_text(json.dumps(made), encoding="utf-8")
    library = Tokenizer.from_file(str(path))
    monkeypatch.setattr(packing, "TOGETHER", 50)
    coder = packing.WordCoder(str(path))
    for first in range(0, 0x10000, 4096):
        texts = [f"a{chr(k)}B {chr(k)}'ll{chr(k)}" for k in range(first, first + 4096, 1 if first < 4096 else 5) if not 0xD800 <= k < 0xE000]
        assert [a.tolist() for a in coder.encode_batch(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert coder.encode_batch([]) == [] and [len(a) for a in coder.encode_batch(["", " \n"])] == [0, 0]


def test_slices_do_not_change_sequences(spark, monkeypatch):
    docs = spark.createDataFrame([(k, "some words " * (k % 90)) for k in range(1300)], "doc_id long, text string").coalesce(1)
    got = []
    for chars in (1, 200_000, 10**9):
        monkeypatch.setattr(packing, "SLICE_CHARS", chars)
        got.append([tuple(r) for r in packing.pack_documents(docs, max_tokens=64).collect()])
    assert sorted(got[0]) == sorted(got[1]) == sorted(got[2]) and len({r[0] for r in got[0]}) == 1300


@pytest.mark.parametrize("together", [1, 2, 7, 1000])
def test_archives_in_parts(together):
    """Pieces as the text source cuts them, several to a batch."""
    block = b"a\r\n\r\nWARC/1.1\r\n" * 60
    head = lambda n: f"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: {n}\r\n\r\n".encode()
    data = b"".join(head(n) + block[:n] + b"\r\n\r\n" for n in (0, 3, 5, 800, 2))
    pieces = [p + b"\r\n\r\n" for p in data.split(b"\r\n\r\n")]
    parts = [b"".join(pieces[i : i + together]) for i in range(0, len(pieces), together)]
    assert [len(r[-1]) for r in warc.parse_parts(parts)] == [0, 3, 5, 800, 2]
    with pytest.raises(ValueError):
        list(warc.parse_parts([data[:-8]]))


LINE = ("word " * 30).strip()


@pytest.mark.parametrize("html,want", [
    (f"<div class='post category-social'><h1>T</h1><p>{LINE}</div>", ["T", LINE]),
    (f"<div class='tags-page'><main><p>{LINE}</main></div>", [LINE]),
    (f"<div class='two-sidebar-menu'><article><p>{LINE}</article><div class=menu>x y</div></div>", [LINE]),
    (f"<div id='comments-enabled-page'><article><p>{LINE}</article><div class=comments><p>{LINE * 9}</div></div>", [LINE]),
    (f"<form id=aspnetForm><nav>n</nav><div id=content><h1>A</h1><p>{LINE}</div></form>", ["A", LINE]),
    ("<div class=ad>" * 3000 + f"<h1>{LINE}</h1>", [LINE]),
    ("<div class=cookie>we use cookies</div>", []),
    (f"<p>{LINE}</p><div class=comments><h1>No</h1>{LINE * 9}</div>", [LINE]),
    (f"<div hidden class=ad><h1>{LINE * 9}</h1></div><div class=promo><nav>{LINE * 9}</nav></div>", []),
    ("<p>next <script>var a</script> end</p>", ["next end"]),
    ("<p>a <select><option>x<option>y</select> b <button><p>q</p></button> c<svg><path></svg>d</p>e", ["a b cd", "e"]),
])
def test_names_do_not_cost_the_article(html, want):
    assert [text for text, *_ in extraction.Page(html).blocks] == want


LONG, SHORT = "a long story told in full " * 40, "and a short one beside it"


@pytest.mark.parametrize(
    "html, want",
    [
        (f"<body><article>{LONG}</article><article>{SHORT}</article>", [LONG, SHORT]),
        (f"<body><section>{SHORT}</section><section>{LONG}</section>", [SHORT, LONG]),
        (f"<main><p>{SHORT}</p><article>{LONG}</article></main>", [SHORT, LONG]),
        (f"<body><div class=c><article>{LONG}</article></div><div class=d><p>{SHORT}</p></div>{SHORT}", [LONG, SHORT, SHORT]),
        (f"<body><article>{LONG}</article><div><a href=x>one</a> <a href=y>two</a> -</div>", [LONG]),
        (f"<body><a href=x><article>{LONG}</article></a><div>{SHORT}</div>", [LONG, SHORT]),
        (f"<body><article>{LONG}</article><div class=comments>{SHORT}</div><aside>{SHORT}</aside>", [LONG]),
    ],
)
def test_text_beside_the_best_container(spark, html, want):
    got = extraction.extract_main_text(pages(spark, [(1, "http://h.com/1", html)])).collect()
    assert got[0].text.split("\n") == [w.strip() for w in want]


@pytest.mark.parametrize("hosts", [200_000, 0])
def test_hosts_judge_parts(spark, hosts, monkeypatch):
    """The same words beside different articles go, different words stay; copies of a page are one voice."""
    monkeypatch.setattr(extraction, "BROADCAST_HOSTS", hosts)
    page = lambda k, beside: f"<body><article>{k} {LONG}</article><div class=box>{beside}</div>"
    rows = [(k, "http://same.com/p", page(k, "Buy our fine lamps today")) for k in range(6)]
    rows += [(10 + k, "http://other.com/p", page(k, f"Part two of story {k}")) for k in range(6)]
    rows += [(20 + k, "http://copies.com/p", page(7, "Part two of one story")) for k in range(6)]
    rows += [(30, "http://one.com/p", page(8, "The only page here")), (None, None, None), (41, "http://same.com/q", "")]
    rows += [(42, "http://same.com/q", page(9, "<a href=x>Buy our fine lamps today</a>"))]
    got = {r.page_id: r.text.split("\n")[1:] for r in extraction.extract_main_text(pages(spark, rows)).collect()}
    assert len(got) == len(rows)
    assert all(got[k] == [] for k in [*range(6), None, 41, 42])
    assert all(got[10 + k] == [f"Part two of story {k}"] for k in range(6))
    assert all(got[20 + k] == ["Part two of one story"] for k in range(6))
    assert got[30] == ["The only page here"]
