import hashlib
import random
import time

import pytest
from pyspark.sql import functions as F

from lexmill import schemas
from lexmill.functions import sql
from lexmill.operators import bpe, bpe_train, dictionary, packing, stats, vocab
from lexmill.operators.chars import CharTokenizer
from lexmill.plans import catalog
from lexmill.session import SHUFFLE_CLEANUP, drop_table, write_table
from tests.plain import plain_chunks, plain_encode, plain_merges


def texts(spark, rows):
    return spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, content string")


def words_table(spark, counts):
    return spark.createDataFrame(list(counts.items()), "segment string, n long")


def test_character_vocabulary_and_tokenizer(spark):
    df = texts(spark, ["cab", "b a", ""])
    rows = {r["ch"]: r["id"] for r in vocab.character_vocab(df, "content").collect()}
    assert rows == {"<s>": 0, "</s>": 1, "<unk>": 2, " ": 3, "a": 4, "b": 5, "c": 6}
    tok = CharTokenizer.from_vocab(vocab.character_vocab(df, "content"))
    got = texts(spark, ["ab z", "", "中\U000f0003a"]).select(
        tok.encode(F.col("content"), bos=True, eos=True).alias("ids"), tok.decode(tok.encode(F.col("content"))).alias("t")
    )
    assert [(r["ids"], r["t"]) for r in got.collect()] == [
        ([0, 4, 5, 3, 2, 1], "ab <unk>"),
        ([0, 1], ""),
        ([0, 2, 2, 4, 1], "<unk><unk>a"),
    ]


def test_alphabet_order_and_coverage(spark):
    counts = vocab.character_counts(texts(spark, ["aaab", "bc"]), "content")
    assert [r["ch"] for r in vocab.covered_alphabet(counts).orderBy("rank").collect()] == ["a", "b", "c"]
    assert [r["ch"] for r in vocab.covered_alphabet(counts, 0.5).orderBy("rank").collect()] == ["a"]


def test_segments_keep_digits_controls_and_word_starts_apart(spark):
    lines = spark.createDataFrame([("ab12cd e\tfg x▁yz  7",)], "line string")
    segments = vocab.segment_counts(vocab.word_counts(lines)).collect()
    assert {r["segment"]: r["n"] for r in segments} == {"▁ab": 1, "cd": 1, "▁e": 1, "fg": 1, "▁x": 1, "▁yz": 1}
    chars = {r["ch"] for r in vocab.word_alphabet(vocab.word_counts(lines)).collect()}
    assert chars == set("▁ab12cdefgxyz7")


def test_pair_counts_of_long_segments(spark):
    rng = random.Random(4)
    long = "".join(rng.choice("abé中") for _ in range(1000))
    data = {long: 3, "ab": 2, "a": 9, "b" * 64: 1, "c" * 65: 1}
    want = {}
    for w, n in data.items():
        for p in zip(w, w[1:]):
            want[p] = want.get(p, 0) + n
    got = vocab.pair_counts(words_table(spark, data)).collect()
    assert {(r["a"], r["b"]): r["n"] for r in got} == want


@pytest.mark.parametrize("seed", range(3))
def test_batched_merges_equal_single_merges(spark, seed, monkeypatch):
    monkeypatch.setattr(bpe_train, "FIRST_PAIRS", [64, 2, 5][seed])
    monkeypatch.setattr(bpe_train, "MOST_PAIRS", [16_384, 3, 16_384][seed])
    monkeypatch.setattr(bpe_train, "MOST_PARTS", [100_000, 100_000, 4][seed])
    monkeypatch.setattr(bpe_train, "HELD_PARTS", [50_000, 2, 2][seed])
    rng = random.Random(seed)
    letters = "abcde"[: 2 + seed]
    data = {}
    for _ in range(60):
        w = "▁" + "".join(rng.choice(letters) for _ in range(rng.randint(1, 9)))
        data[w] = data.get(w, 0) + rng.randint(1, 6)
    want = plain_merges(data, 30)
    got = bpe_train.learn_merges(words_table(spark, data), 30, {c for w in data for c in w})
    assert got == want


def test_merges_with_ties_runs_and_length_cap(spark):
    data = {"aaaaaaaaaaaaaaaaaaaaaaaa": 2, "abab": 3, "baba": 3, "cdcd": 3, "dc": 3}
    want = plain_merges(data, 25)
    assert bpe_train.learn_merges(words_table(spark, data), 25, set("abcd")) == want
    known = {"low": 5, "lower": 2, "newest": 6, "widest": 3}
    assert bpe_train.learn_merges(words_table(spark, known), 10, set("lowernstid")) == plain_merges(known, 10)


def test_ties_wider_than_a_round(spark, monkeypatch):
    """Every pair occurs equally often and one pair is ranked at a time, so each round takes the first in order."""
    monkeypatch.setattr(bpe_train, "FIRST_PAIRS", 1)
    monkeypatch.setattr(bpe_train, "MOST_PAIRS", 1)
    data = {"bad": 2, "cab": 2, "dcb": 2, "acd": 2}
    assert bpe_train.learn_merges(words_table(spark, data), 8, set("abcd")) == plain_merges(data, 8)


def test_few_rounds_for_many_merges(spark, monkeypatch):
    """Rounds follow the spread of the counts, not the number of merges."""
    rng = random.Random(11)
    data = {"▁" + "".join(rng.choices("abcdefghijklmnop", range(16, 0, -1), k=rng.randint(2, 12))): rng.randint(1, 500) for _ in range(300)}
    rounds = []
    replace = bpe_train.SegmentTable.replace
    monkeypatch.setattr(bpe_train.SegmentTable, "replace", lambda self, df: (rounds.append(1), replace(self, df))[1])
    got = bpe_train.learn_merges(words_table(spark, data), 120, {c for w in data for c in w})
    assert got == plain_merges(data, 120)
    assert len(rounds) <= 6


def test_vocabulary_layout_and_errors(spark):
    words = spark.createDataFrame([("▁low", 5), ("▁lower", 2), ("▁newest", 6), ("▁widest", 3)], "word string, n long")
    rows = bpe_train.train_vocab(words, 259 + 11 + 6).orderBy("id").collect()
    assert [r["piece"] for r in rows[:4]] == ["<unk>", "<s>", "</s>", "<0x00>"]
    assert rows[258]["piece"] == "<0xFF>" and rows[258]["score"] == 0.0
    assert [r["kind"] for r in rows[259:]] == ["merge"] * 6 + ["char"] * 11
    assert [r["score"] for r in rows[259:262]] == [0.0, -1.0, -2.0]
    assert rows[265]["piece"] == "e"
    with pytest.raises(ValueError):
        bpe_train.train_vocab(words, 262)
    with pytest.raises(ValueError):
        bpe_train.train_vocab(words, 0)


PIECES = ["▁a", "▁b", "lo", "low", "▁low", "er", "▁", "a", "b", "l", "o", "w", "e", "r", "2", "0", "4"]


def small_tokenizer():
    rows = bpe_train.vocab_rows(PIECES[:6], PIECES[6:])
    return bpe.BpeTokenizer([r[1] for r in rows])


def test_encode_edge_cases(spark):
    tok = small_tokenizer()
    ids = tok.piece_ids()
    cases = ["", "a\nb", "\ta  b", "中", "2024", "lower low", "a▁b", "▁ b", "  ", "lowlowlow" * 200]
    got = texts(spark, cases).select("doc_id", tok.encode(F.col("content"), True, True).alias("t")).collect()
    for r in got:
        assert r["t"] == [1] + plain_encode(cases[r["doc_id"]], ids) + [2]
    by_case = {cases[r["doc_id"]]: r["t"][1:-1] for r in got}
    assert by_case["a\nb"] == [ids["▁a"], 13, ids["b"]]
    assert by_case["中"] == [ids["▁"], 231, 187, 176]
    assert by_case["2024"] == [ids["▁"], ids["2"], ids["0"], ids["2"], ids["4"]]


def test_decode_restores_text(spark):
    tok = small_tokenizer()
    cases = ["a\nb", "\ta  b", "中 é", "lower 2024", "", "a▁b"]
    got = texts(spark, cases).select("doc_id", tok.decode(tok.encode(F.col("content"), True, True)).alias("t"))
    want = ["a\nb", "\ta b", "中 é", "lower 2024", "", "a b"]
    assert [r["t"] for r in got.orderBy("doc_id").collect()] == want
    broken = spark.createDataFrame([([3 + 0xE4, 3 + 0xB8],)], "ids array<int>")
    assert "�" in broken.select(tok.decode(F.col("ids")).alias("t")).first()["t"]


def test_encode_equals_the_public_tokenizer(spark, small_dir):
    spm = pytest.importorskip("sentencepiece")
    import io

    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", F.col("text").alias("content"))
    all_texts = {r["doc_id"]: r["content"] for r in docs.collect()}
    model = io.BytesIO()
    lines = [line for t in all_texts.values() for line in t.split("\n")]
    spm.SentencePieceTrainer.train(
        sentence_iterator=iter(lines), model_writer=model, model_type="bpe", vocab_size=1000,
        character_coverage=1.0, split_digits=True, allow_whitespace_only_pieces=True, byte_fallback=True,
        normalization_rule_name="identity", minloglevel=2,
    )
    sp = spm.SentencePieceProcessor(model_proto=model.getvalue())
    tok = bpe.BpeTokenizer([sp.id_to_piece(i) for i in range(sp.vocab_size())])
    got = docs.select("doc_id", tok.encode(F.col("content")).alias("t")).collect()
    assert all(r["t"] == sp.encode(all_texts[r["doc_id"]]) for r in got)
    back = docs.select("doc_id", tok.decode(tok.encode(F.col("content"))).alias("t")).collect()
    assert all(r["t"] == sp.decode(sp.encode(all_texts[r["doc_id"]])) for r in back)


def test_sql_functions(spark):
    sql.register(spark, small_tokenizer())
    r = spark.sql(
        "SELECT bpe_encode('low a') AS t, strip_text('\u3000 a\tb\n') AS s, word_total(' a\tb ') AS w, "
        "chunk_total(13, 6) AS c, shuffle_key(678, 5) AS k"
    ).first()
    assert (r["t"], r["s"], r["w"], r["c"]) == ([263, 259], "a\tb", 2, 1)
    assert r["k"] == hashlib.md5(b"678:5").hexdigest()


def test_packing_in_sql_equals_the_operator(spark):
    sql.register(spark)
    rng = random.Random(8)
    docs = [(rng.choice([0, 0, 1]), [rng.randint(0, 9) for _ in range(rng.choice([0, 1, 3, 20]))]) for _ in range(30)]
    streams = packing.document_offsets(token_rows(spark, docs))
    streams.createOrReplaceTempView("streams")
    got = spark.sql(
        "SELECT shard, chunk, flatten(transform(array_sort(collect_list(struct(start, ids))), p -> p.ids)) AS ids "
        "FROM streams, LATERAL chunk_pieces(tokens, offset, stream_len, 4) GROUP BY shard, chunk"
    )
    want = packing.chunks(streams, 4)
    assert got.exceptAll(want).isEmpty() and got.count() == want.count()


def token_rows(spark, docs, parts=3):
    rows = [(s, f"{i:04x}", i, len(t), t) for i, (s, t) in enumerate(docs)]
    return spark.createDataFrame(
        rows, "shard int, ord string, doc_id long, n int, tokens array<int>"
    ).repartition(parts)


@pytest.mark.parametrize("context,parts", [(4, 1), (4, 4), (6, 13), (1, 3)])
def test_chunks_equal_slices(spark, context, parts):
    rng = random.Random(context)
    docs = [(rng.choice([0, 0, 0, 1, 2]), [rng.randint(0, 99) for _ in range(rng.choice([0, 1, 3, 20, 70]))]) for _ in range(40)]
    streams = {}
    for s, t in docs:
        streams.setdefault(s, []).extend(t)
    want = {(s, i): c for s, t in streams.items() for i, c in enumerate(plain_chunks(t, context))}
    got = packing.chunks(packing.document_offsets(token_rows(spark, docs, parts)), context).collect()
    assert {(r["shard"], r["chunk"]): r["ids"] for r in got} == want and len(got) == len(want)
    listed = packing.chunk_list(packing.stream_lengths(token_rows(spark, docs), spark.createDataFrame([(0,), (1,), (2,), (3,)], "shard int")), context)
    assert {(r["shard"], r["chunk"]) for r in listed.collect()} == set(want)


@pytest.mark.parametrize("length,n", [(6, 0), (12, 1), (13, 1), (18, 2), (19, 2)])
def test_chunk_count_and_report(spark, length, n):
    docs = [(0, list(range(length)))]
    tokens = token_rows(spark, docs)
    assert packing.chunks(packing.document_offsets(tokens), 6).count() == n
    lengths = packing.stream_lengths(tokens, spark.createDataFrame([(0,), (1,)], "shard int"))
    bad = {r["shard"] for r in packing.bad_shards(lengths, 6).collect()}
    assert bad == ({0, 1} if n == 0 else {1})
    with pytest.raises(ValueError):
        packing.bad_shards(lengths, 6, strict=True)


def test_next_token_shift_and_prefixes(spark):
    chunk = [2582, 515, 1422, 3736, 1103, 3145, 373]
    df = spark.createDataFrame([(0, chunk)], "shard int, ids array<int>")
    r = packing.examples(df, 6).first()
    assert r["x"] == [2582, 515, 1422, 3736, 1103, 3145] and r["y"] == [515, 1422, 3736, 1103, 3145, 373]
    rows = packing.prefix_examples(df, 6).collect()
    assert [(r["prefix"], r["target"]) for r in rows] == [(chunk[: i + 1], chunk[i + 1]) for i in range(6)]


def test_uint16(spark):
    df = spark.createDataFrame([(0, [65535]), (1, [65536, -1])], "shard int, tokens array<int>")
    assert {r["shard"]: r["n_bad"] for r in packing.uint16_violations(df).collect()} == {0: 0, 1: 2}
    assert df.where("shard = 0").select(packing.narrow_ids(F.col("tokens"))).count() == 1
    with pytest.raises(Exception, match="outside"):
        df.select(packing.narrow_ids(F.col("tokens"))).collect()


def test_batches_run_over_epochs(spark):
    ordered = spark.createDataFrame(
        [("train", 0, e, s, c, c) for e in (0, 1) for s in (10, 5) for c in range(3)],
        "split string, worker int, epoch int, shard int, chunk long, pos_in_shard long",
    )
    lengths = spark.createDataFrame(
        [("train", 0, 0, 10, 16), ("train", 0, 1, 5, 16)], "split string, worker int, file_no int, shard int, stream_len long"
    )
    rows = packing.batches(ordered, lengths, 4, 4).collect()
    order = [(e, s, c) for e in (0, 1) for s in (10, 5) for c in range(3)]
    got = {(r["batch_id"], r["pos"]): (r["epoch"], r["shard"], r["chunk"]) for r in rows}
    assert got == {(i // 4, i % 4): v for i, v in enumerate(order)}
    ex = spark.createDataFrame([(s, c, [s], [c]) for s in (10, 5) for c in range(3)], "shard int, chunk long, x array<int>, y array<int>")
    whole = packing.collect_batches(packing.batches(ordered, lengths, 4, 4), ex).orderBy("batch_id").collect()
    assert [[(e["x"][0], e["y"][0]) for e in r["examples"]] for r in whole][0] == [(10, 0), (10, 1), (10, 2), (5, 0)]


def test_shard_stats_and_plan(spark):
    tokens = token_rows(spark, [(0, [1, 5, 2]), (0, [1, 2]), (2, [1, 9, 9, 2])])
    every = spark.createDataFrame([(0,), (1,), (2,)], "shard int")
    got = {r["shard"]: (r["n_tokens"], r["mean_len"]) for r in stats.shard_stats(tokens, every).collect()}
    assert got == {0: (5, 2.5), 1: (0, None), 2: (4, 4.0)}
    plan = stats.steps_plan(spark.createDataFrame([(1_100_000_000,)], "n_tokens long"), 256, 32).first()
    assert plan["tokens_per_step"] == 8192 and int(plan["n_steps"]) == 134277


def test_loglog_fit_on_published_points(spark):
    # Published pairs of parameters and tokens.
    points = [
        (400e6, 7.7e9), (1e9, 20.0e9), (10e9, 219.5e9), (67e9, 1.7e12), (175e9, 4.3e12),
        (280e9, 7.1e12), (520e9, 13.4e12), (1e12, 26.5e12), (10e12, 292.0e12),
    ]
    df = spark.createDataFrame([("a", x, y) for x, y in points], "grp string, x double, y double")
    r = stats.loglog_fit(df).withColumn("at", stats.loglog_predict(F.col("m"), F.col("c"), 1.2e9)).first()
    assert (round(r["m"], 5), round(r["c"], 5)) == (1.04096, 0.93539)
    assert abs(r["at"] - 2.4346e10) < 1e6


def test_vocab_schema_is_stable():
    assert schemas.VOCAB.names == ["id", "piece", "score", "kind"]


def test_many_merges_equal_single_merges(spark):
    rng = random.Random(5)
    data = {"▁" + "".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 12))): rng.randint(1, 500) for _ in range(80)}
    letters = {c for w in data for c in w}
    got = bpe_train.learn_merges(words_table(spark, data), 90, letters)
    assert len(got) == 90 and got == plain_merges(data, 90)


def test_queries_train_the_default_vocabulary(monkeypatch):
    from lexmill.plans import catalog

    sizes = []

    def asked(articles, size):
        sizes.append(size)
        raise StopIteration

    monkeypatch.setattr(catalog.flows, "bpe_vocab", asked)
    monkeypatch.setattr(catalog, "_articles", lambda *a: None)
    monkeypatch.setattr(catalog, "fresh_path", lambda *a: "none")
    for query in (catalog.bpe_vocab, catalog.bpe_roundtrip, catalog.bpe_shard_stats):
        with pytest.raises(StopIteration):
            query(None, "none")
    assert sizes == [2_000] * 3


@pytest.mark.parametrize("frequent", [3, 10_000])
def test_dictionary_encoding_equals_map_only(spark, monkeypatch, frequent):
    """With a low bound hardly a word is frequent, with a high one all are."""
    from lexmill.operators import dictionary

    monkeypatch.setattr(dictionary, "FREQUENT", frequent)
    rng = random.Random(12)
    rows = [(k, " ".join(rng.choice(["low", "lower", "a▁b", "▁", "2024", "é中", "x\ny", "", "a", "b"]) for _ in range(rng.randrange(30)))) for k in range(60)]
    rows += [(1, rows[1][1]), (None, "low a"), (100, None), (101, ""), (102, "   "), (103, "low " * 5_000)]
    texts = spark.createDataFrame([(i, t, 5, "w") for i, t in rows], "doc_id long, content string, place int, word string").repartition(3)
    tokenizer = small_tokenizer()
    got = dictionary.dictionary_encode(texts, tokenizer).select("doc_id", "content", "ids")
    want = texts.select("doc_id", "content", tokenizer.encode(F.col("content")).alias("ids"))
    assert got.count() == len(rows) and got.exceptAll(want).isEmpty()
    assert dictionary.dictionary_encode(texts.limit(0), tokenizer).count() == 0


def test_tokenizers_in_sql(spark):
    bpe_tokenizer = small_tokenizer()
    chars = CharTokenizer({"<s>": 0, "</s>": 1, "<unk>": 2, "a": 3, "'": 4, "é": 5, "😀": 6, " ": 7})
    sql.register(spark, bpe_tokenizer, chars)
    texts = spark.createDataFrame([("low a",), ("",), ("é'😀 z",), (" a  b",), (None,)], "t string")
    got = spark.sql(
        "SELECT bpe_encode(t) AS b, bpe_decode(bpe_encode(t)) AS bt, char_encode(t) AS c, char_decode(char_encode(t)) AS ct FROM {texts}",
        texts=texts,
    )
    t = F.col("t")
    want = texts.select(
        bpe_tokenizer.encode(t), bpe_tokenizer.decode(bpe_tokenizer.encode(t)), chars.encode(t), chars.decode(chars.encode(t))
    )
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.collect())))


@pytest.mark.parametrize("width", [1, 2, 100])
def test_packing_in_sql_equals_plain_chunks(spark, width):
    rng = random.Random(width)
    context, rows, streams = 4, [], {}
    for shard, lengths in enumerate([[3, 1, 20, 0, 7], [2, 2], [], [50], [4, 4], [1] * 30, [9]]):
        stream = [rng.randrange(100) for _ in range(sum(lengths))]
        streams[shard], at = stream, 0
        for n in lengths:
            rows.append((shard, at, len(stream), stream[at : at + n]))
            at += n
    table = spark.createDataFrame(rows, "shard int, offset long, stream_len long, tokens array<int>").repartition(3)
    sql.register(spark)
    got = spark.sql(
        """SELECT * FROM pack_chunks(
             TABLE(SELECT s.shard, b.block, b.start, b.ids
                   FROM {streams} AS s, LATERAL stream_blocks(tokens, offset, stream_len, {context}, {width}) AS b)
             PARTITION BY (shard, block) ORDER BY (start), {context})""",
        streams=table, context=context, width=width,
    ).collect()
    want = [(s, i, c[:-1], c[1:]) for s, stream in streams.items() for i, c in enumerate(plain_chunks(stream, context))]
    assert sorted((r["shard"], r["chunk"], r["x"], r["y"]) for r in got) == sorted(want)


def test_parts_of_blocks_keep_documents_in_their_rows(spark):
    """The array of parts equals the table function's rows, and its plan neither joins nor groups by tokens."""
    rows = [(0, 0, 31, list(range(20))), (0, 20, 31, []), (0, 20, 31, list(range(11))), (1, 0, 3, [1, 2, 3]), (2, 0, 0, None)]
    table = spark.createDataFrame(rows, "shard int, offset long, stream_len long, tokens array<int>")
    sql.register(spark)
    want = spark.sql(
        "SELECT s.shard, b.* FROM {t} AS s, LATERAL stream_blocks(tokens, offset, stream_len, 4, 2) AS b", t=table
    )
    got = spark.sql(
        "SELECT shard, inline(parts) AS (block, start, ids) FROM (SELECT shard, block_parts(tokens, offset, stream_len, 4, 2) AS parts FROM {t})",
        t=table,
    )
    assert got.count() and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan


def test_characters_are_encoded_and_found_in_batches(spark):
    texts = spark.createDataFrame([("ab\U0001f600a\0",), (None,), ("",), ("b￿é",)], "content string")
    assert sorted(r["ch"] for r in vocab.distinct_characters(texts, "content").collect()) == sorted("ab\U0001f600\0￿é")
    tokenizer = CharTokenizer({"<s>": 0, "</s>": 1, "<unk>": 2, "a": 3, "é": 4})
    encoded = texts.select(tokenizer.encode(F.col("content")).alias("ids"), tokenizer.encode(F.col("content"), True, True).alias("marked"))
    got = encoded.collect()
    assert [r["ids"] for r in got] == [[3, 2, 2, 3, 2], None, [], [2, 2, 4]]
    assert [r["marked"] for r in got] == [[0, 3, 2, 2, 3, 2, 1], None, [0, 1], [0, 2, 2, 4, 1]]
    # No lookup runs once per character inside the plan.
    assert "lambdafunction" not in encoded._jdf.queryExecution().optimizedPlan().toString()


def test_words_are_added_up_by_tasks_in_bounded_memory(spark, monkeypatch):
    monkeypatch.setattr(vocab, "HELD_WORDS", 2)
    lines = spark.createDataFrame([("a b  a",), (None,), ("",), ("c\td ▁ a b",), (" ",)], "line string").coalesce(1)
    counted = vocab.word_counts(lines)
    assert {tuple(r) for r in counted.collect()} == {("▁a", 3), ("▁b", 2), ("▁c\td", 1), ("▁▁", 1)}
    assert "MapInArrow" in counted._jdf.queryExecution().executedPlan().toString()


def test_prefixes_expand_different_chunks_only(spark, monkeypatch):
    """Equal chunks meet before they are expanded to one row per position."""
    seen = []
    expand = packing.prefix_examples
    monkeypatch.setattr(packing, "prefix_examples", lambda df, c: (seen.append(df), expand(df, c))[1])
    streams = [("0", 0, 1, [1, 2, 3, 4] * 5), ("1", 1, 2, [1, 2, 3, 4] * 5)]
    tokens = spark.createDataFrame(streams, "ord string, shard int, doc_id long, tokens array<int>").withColumn("n", F.size("tokens"))
    monkeypatch.setattr(catalog, "_stored_char_tokens", lambda s, d: (tokens, None))
    got = {(r["prefix"], r["target"]): r["n"] for r in catalog.prefixes(spark, "").collect()}
    assert got == {("1", 2): 8, ("1 2", 3): 8, ("1 2 3", 4): 8, ("1 2 3 4", 1): 8}
    assert seen[0].count() == 1


def test_words_of_a_row_are_gathered_in_the_row(spark):
    texts = [" a  b▁a c", None, "", "▁", "é a\nb a"]
    rows = spark.createDataFrame(list(enumerate(texts)), "_row long, content string")
    got = dictionary.word_places(rows, "content")
    want = rows.select("_row", F.posexplode(dictionary.marked_words("content")).alias("place", "word"))
    want = want.groupBy("_row", "word").agg(F.sort_array(F.collect_list("place")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count()
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("block_bytes, held_bytes", [(1, 1), (150, 200), (16_000_000, 16_000_000)])
def test_rows_come_back_whole_from_blocks(spark, monkeypatch, block_bytes, held_bytes):
    """Blocks of one row, of some rows, of all rows of a task; other columns of any kind and broken UTF-8 stay as they are."""
    monkeypatch.setattr(dictionary, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(dictionary, "HELD_BYTES", held_bytes)
    texts = ["low lower", None, "", "  ", "a▁b ▁", "low " * 40 + "é中", "b a b", "x\ny a", "low lower", "▁▁a"] * 3
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, content string").repartition(3, "doc_id")
    rows = rows.withColumn("content", F.when(F.col("doc_id") == 2, F.expr("cast(x'61ff20c3' as string)")).otherwise(F.col("content")))
    rows = rows.withColumns({
        "row": F.array("doc_id", F.lit(None)), "at": F.expr("if(doc_id % 2 = 0, timestamp_micros(doc_id), null)"), "text": F.lit("w"),
        "m": F.create_map(F.lit("k"), F.struct("doc_id")), "d": F.col("doc_id").cast("decimal(20, 2)"), "b": F.col("content").cast("binary"),
    })
    tokenizer = small_tokenizer()
    got = dictionary.dictionary_encode(rows, tokenizer)
    assert got.columns == [*rows.columns, "ids"] and got.select("ids").schema[0].dataType.simpleString() == "array<int>"
    got = got.select(*[F.to_json(F.struct(c)).alias(c) if c == "m" else F.col(c) for c in got.columns])
    want = rows.withColumns({"m": F.to_json(F.struct("m")), "ids": tokenizer.encode(F.make_valid_utf8("content"))})
    assert got.count() == len(texts) and got.exceptAll(want).isEmpty()


def test_dictionary_moves_the_words_of_blocks(spark, monkeypatch):
    """Rows of a task share their words: 2,000 rows of 5 words in 2 tasks make 10 pairs, and nothing is shuffled row by row."""
    written = {}

    def counted(df, label, **options):
        table, path = write_table(df, label, **options)
        written[label] = table.count()
        return table, path

    monkeypatch.setattr(dictionary, "write_table", counted)
    texts = spark.range(0, 2_000, 1, 2).select(F.col("id").alias("doc_id"), F.lit("low lower a b a c").alias("content"))
    got = dictionary.dictionary_encode(texts, small_tokenizer())
    assert written["word-places"] == 10 and written["blocks"] == 2
    assert got.count() == 2_000 and got.select("ids").distinct().count() == 1


def test_a_written_table_leaves_no_shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {str(f) for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(manager.getAllFiles()) if "shuffle_" in str(f)}

    before = files()
    table, path = write_table(spark.range(10_000).groupBy((F.col("id") % 7).alias("k")).count(), "grouped")
    end = time.monotonic() + 20
    while files() - before and time.monotonic() < end:
        time.sleep(0.1)
    assert not files() - before and table.count() == 7
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
    drop_table(spark, path)
