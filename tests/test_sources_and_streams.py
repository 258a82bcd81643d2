import os
import struct
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lexmill.operators import bpe_train, corpus, shards
from lexmill.operators.chars import CharTokenizer
from lexmill.plans import flows
from lexmill.session import drop_table, folder_names, fresh_path, path_exists, publish_folder, write_table
from lexmill.sources import corpus as corpus_io
from lexmill.sources import jsonl, tokbin, vocabfile
from lexmill.streaming import ingest


def raw(spark, n=60):
    return spark.range(n).select(
        F.col("id").alias("doc_id"),
        F.col("id").cast("string").alias("id"),
        F.lit(None).cast("string").alias("url"),
        F.concat(F.lit('t "é" '), "id").alias("title"),
        F.concat(F.lit("  text\n\t"), F.repeat(F.lit("wörd "), (F.col("id") % 9).cast("int")), F.col("id").cast("string")).alias("text"),
    )


def tokenizer(spark):
    chars = sorted(set("text\n\twörd 0123456789"))
    return CharTokenizer({"<s>": 0, "</s>": 1, "<unk>": 2, **{c: i + 3 for i, c in enumerate(chars)}})


def test_corpus_cache_is_read_not_rebuilt(spark):
    path = fresh_path(spark, "cache")
    first = corpus_io.load_articles(raw(spark), path, 0.5)
    assert first.columns == ["doc_id", "title", "content"]
    assert {r["doc_id"] for r in first.collect()} == set(range(30))
    again = corpus_io.load_articles(raw(spark), path, 0.5)
    assert sorted(again.inputFiles()) == sorted(first.inputFiles())
    assert corpus.records(again).columns == ["title", "content"]


def test_another_fraction_or_source_makes_another_cache(spark):
    path, source = fresh_path(spark, "cache"), fresh_path(spark, "source")
    raw(spark, 20).write.parquet(source)
    half = corpus_io.load_articles(spark.read.parquet(source), path, 0.5)
    whole = corpus_io.load_articles(spark.read.parquet(source), path, 1.0)
    assert (half.count(), whole.count()) == (10, 20)
    files = half.inputFiles()
    assert corpus_io.load_articles(spark.read.parquet(source), path, 0.5).inputFiles() == files
    raw(spark, 30).where("id >= 20").write.mode("append").parquet(source)
    assert corpus_io.load_articles(spark.read.parquet(source), path, 0.5).count() == 15
    assert half.count() == 10
    assert not [n for n in folder_names(spark, path) if n.startswith(".")]


def test_a_cache_that_another_writer_finished_stays(spark):
    aside, path = fresh_path(spark, "aside"), fresh_path(spark, "named")
    raw(spark, 3).write.parquet(path)
    raw(spark, 4).write.parquet(aside)
    publish_folder(spark, aside, path)
    assert spark.read.parquet(path).count() == 3 and not path_exists(spark, aside)


def test_shard_files_keep_order_and_guard_the_target(spark):
    path = fresh_path(spark, "shards")
    flows.prepare_shuffle(raw(spark), path, 7)
    index = shards.shuffle_index(raw(spark), 7).join(raw(spark), "doc_id").orderBy("rnk").collect()
    lines = jsonl.number_lines(jsonl.read_shards(spark, path)).orderBy("shard", "rnk").collect()
    assert [(r["shard"], r["title"], r["content"]) for r in lines] == [(r["shard"], r["title"], r["text"]) for r in index]
    with pytest.raises(Exception, match="(?i)exists"):
        flows.prepare_shuffle(raw(spark), path, 7)
    flows.prepare_shuffle(raw(spark, 20), path, 3, overwrite=True)
    assert jsonl.read_shards(spark, path).count() == 20


def test_lines_of_a_file_read_in_many_splits(spark):
    path = fresh_path(spark, "splits")
    flows.prepare_shuffle(raw(spark, 300), path, 2)
    want = [r["title"] for r in jsonl.number_lines(jsonl.read_shards(spark, path)).orderBy("shard", "rnk").collect()]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        lines = jsonl.read_shards(spark, path)
        assert lines.rdd.getNumPartitions() > 5
        got = [r["title"] for r in jsonl.number_lines(lines).orderBy("shard", "rnk").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == want


def test_text_export_gives_one_line_per_line(spark):
    path = fresh_path(spark, "text")
    table = corpus.stripped(corpus.articles(raw(spark, 5)))
    corpus_io.export_text(table, path)
    got = sorted(r["line"] for r in corpus_io.read_text_lines(spark, path).collect())
    want = sorted(line for r in table.collect() for line in r["content"].split("\n"))
    assert got == want


def test_token_files(spark):
    table = corpus.stripped(corpus.articles(raw(spark)))
    tokens = flows.token_table(table, tokenizer(spark), 5)
    folder = fresh_path(spark, "tok")
    tokbin.write_token_files(tokens, folder, 5)
    want = {}
    for r in tokens.orderBy("shard", "ord", "doc_id").collect():
        want.setdefault(r["shard"], []).extend(r["tokens"])
    assert sorted(os.listdir(folder)) == ["_manifest.json"] + [f"shard_{i}.bin" for i in range(5)]
    with open(f"{folder}/shard_3.bin", "rb") as f:
        data = f.read()
    assert list(struct.unpack(f"<{len(data) // 2}H", data)) == want[3]
    got = {}
    for r in tokbin.read_token_files(spark, folder, 16).orderBy("shard", "start").collect():
        assert r["start"] == len(got.setdefault(r["shard"], []))
        got[r["shard"]].extend(r["tokens"])
    assert got == want
    with pytest.raises(FileExistsError):
        tokbin.write_token_files(tokens, folder, 5)
    tokbin.write_token_files(tokens.where("shard < 2"), folder, 5, overwrite=True)
    assert sorted(os.listdir(folder)) == ["_manifest.json", "shard_0.bin", "shard_1.bin"]
    with pytest.raises(Exception, match="no token files"):
        os.makedirs(f"{folder}-empty")
        tokbin.read_token_files(spark, f"{folder}-empty").collect()


def read_back(df):
    got = {}
    for r in df.orderBy("shard", "start").collect():
        assert r["start"] == len(got.setdefault(r["shard"], []))
        got[r["shard"]].extend(r["tokens"])
    return got


def test_several_writers_of_a_shard(spark):
    """Parts of any length; blocks reach over their borders, and readers without a manifest know whole files only."""
    folder = fresh_path(spark, "tok")
    tokens = flows.stored_tokens(corpus.stripped(corpus.articles(raw(spark, 90))), tokenizer(spark), 4)
    want = {}
    for r in tokens.orderBy("shard", "ord", "doc_id").collect():
        want.setdefault(r["shard"], []).extend(r["tokens"])
    tokbin.write_token_files(tokens, folder, 4, writers=3)
    names = [n for n in os.listdir(folder) if n.endswith(".bin")]
    assert sum(".part_" in n for n in names) >= 8 and not any(n.startswith("_attempt") for n in os.listdir(folder))
    for block in (7, 64, 4096):
        assert read_back(tokbin.read_token_files(spark, folder, block)) == want
    lengths = {r["shard"]: r["stream_len"] for r in tokbin.shard_lengths(spark, folder).collect()}
    assert lengths == {s: len(t) for s, t in want.items()}
    whole = fresh_path(spark, "tok")
    tokbin.write_token_files(tokens, whole, 4, writers=1)
    os.remove(f"{whole}/_manifest.json")
    assert read_back(tokbin.read_token_files(spark, whole, 64)) == want


def test_empty_shards_are_in_the_manifest(spark):
    folder = fresh_path(spark, "tok")
    tokens = flows.stored_tokens(corpus.stripped(corpus.articles(raw(spark, 3))), tokenizer(spark), 5)
    tokbin.write_token_files(tokens, folder, 5)
    rows = tokbin.shard_lengths(spark, folder).orderBy("shard").collect()
    assert [r["shard"] for r in rows] == list(range(5)) and [r["stream_len"] > 0 for r in rows] == [True] * 3 + [False] * 2
    tokbin.write_token_files(tokens.limit(0), folder, 5, overwrite=True)
    assert tokbin.read_token_files(spark, folder).count() == 0
    assert tokbin.shard_lengths(spark, folder).where("stream_len = 0").count() == 5


def test_filters_reach_the_token_files(spark, monkeypatch):
    folder = fresh_path(spark, "tok")
    tokens = flows.stored_tokens(corpus.stripped(corpus.articles(raw(spark, 90))), tokenizer(spark), 6)
    tokbin.write_token_files(tokens, folder, 6)
    everything = read_back(tokbin.read_token_files(spark, folder, 16))
    for condition, planned in (
        ("shard = 2", 1), ("shard IN (1, 4)", 2), ("shard >= 3 AND shard < 5", 3), ("shard = 2 AND shard = 3", 1),
        ("shard = 1 AND start >= 64", 1), ("start < 0", 1), ("shard <> 2", 6), ("shard % 2 = 0", 6),
    ):
        blocks = tokbin.read_token_files(spark, folder, 16).where(condition)
        assert blocks.rdd.getNumPartitions() <= planned, condition
        got = {(r["shard"], r["start"]): r["tokens"] for r in blocks.collect()}
        rows = [(s, at, t[at : at + 16]) for s, t in everything.items() for at in range(0, len(t), 16)]
        test = eval("lambda shard, start: " + condition.replace(" = ", " == ").replace("<>", "!=").replace("AND", "and").replace("IN", "in"))
        assert got == {(s, at): t for s, at, t in rows if test(s, at)}


def test_vocabulary_file(spark):
    rows = bpe_train.vocab_rows(["▁a", 'b"', "c'd"], ['"', "#", "\\", " ", "▁"])
    from lexmill import schemas

    vocab = spark.createDataFrame(rows, schemas.VOCAB).repartition(4)
    path = fresh_path(spark, "vocab")
    vocabfile.write_vocab(vocab, path)
    back = vocabfile.read_vocab(spark, path)
    assert [tuple(r) for r in back.orderBy("id").collect()] == rows


def test_written_tables_are_dropped_only_inside_the_shared_folder(spark, tmp_path):
    table, path = write_table(spark.range(3), "x")
    assert table.count() == 3
    drop_table(spark, path)
    assert not path_exists(spark, path)
    other = str(tmp_path / "keep")
    spark.range(1).write.parquet(other)
    drop_table(spark, other)
    assert path_exists(spark, other)


def test_stream_equals_batch(spark):
    path = fresh_path(spark, "in")
    flows.prepare_shuffle(raw(spark, 200), path, 6)
    tok = tokenizer(spark)
    table = corpus.stripped(corpus.articles(raw(spark, 200)))
    tokens = flows.stored_tokens(table, tok, 6)
    want = flows.example_table(tokens, 16, 6).select("shard", "chunk", "x", "y")
    for files in (1, 4):
        out = fresh_path(spark, "out")
        run = ingest.ingest(spark, path, out, fresh_path(spark, "cp"), tok, 16, files)
        run.awaitTermination()
        got = spark.read.parquet(out)
        assert got.select("batch").distinct().count() == -(-6 // files)
        got = got.select("shard", "chunk", "x", "y")
        assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_stream_resumes_with_new_files_only(spark):
    path, out, cp = fresh_path(spark, "in"), fresh_path(spark, "out"), fresh_path(spark, "cp")
    counts, cp2 = fresh_path(spark, "counts"), fresh_path(spark, "cp")
    tok = tokenizer(spark)
    placed = shards.assign_shards(corpus.articles(raw(spark, 80)), 4)
    for part in (0, 1):
        part_rows = placed.where(F.col("shard") % 2 == part)
        part_rows.sort("ord").select("shard", "title", "content").coalesce(1).write.mode("append").partitionBy("shard").json(path)
        ingest.ingest(spark, path, out, cp, tok, 8, 4).awaitTermination()
        ingest.running_counts(spark, path, counts, cp2, tok, 4).awaitTermination()
        assert ingest.latest_counts(spark, counts).count() == 2 * (part + 1)
    shards_seen = spark.read.parquet(out).groupBy("shard", "chunk").count()
    assert shards_seen.select("shard").distinct().count() == 4
    assert shards_seen.where("count > 1").isEmpty()
    assert ingest.latest_counts(spark, counts).agg(F.sum("n_docs")).first()[0] == 80


@pytest.mark.parametrize("files", [1, 8])
def test_growing_shards_equal_whole_shards(spark, files):
    """Three files of each shard, in many batches or few, in one run or three, give the rows of the batch job."""
    path, out, cp = fresh_path(spark, "in"), fresh_path(spark, "out"), fresh_path(spark, "cp")
    tok = tokenizer(spark)
    articles = corpus.articles(raw(spark, 90))
    placed = shards.assign_shards(articles, 4)
    keys = sorted(r["ord"] for r in placed.select("ord").collect())
    cuts = ["", keys[17], keys[58], "z"]
    for low, high in zip(cuts, cuts[1:]):
        part = placed.where((F.col("ord") >= low) & (F.col("ord") < high))
        jsonl.append_files(part, path, 4)
        if files == 8:
            ingest.ingest_growing(spark, path, out, cp, tok, 16, files).awaitTermination()
    if files == 1:
        # Names of the files follow no order, so each shard's own order is read from the stream's batches.
        run = ingest.ingest_growing(spark, path, out, cp, tok, 16, files)
        run.awaitTermination()
    got = spark.read.parquet(out)
    tokens = flows.stored_tokens(corpus.stripped(articles), tok, 4)
    want = flows.example_table(tokens, 16, 4).select("shard", "chunk", "x", "y")
    assert got.count() == want.count()
    assert got.select("shard", "chunk").exceptAll(want.select("shard", "chunk")).isEmpty()
    if files == 8:
        assert got.exceptAll(want).isEmpty()


def test_shards_below_two_windows_wait(spark):
    path, out, cp = fresh_path(spark, "in"), fresh_path(spark, "out"), fresh_path(spark, "cp")
    tok = tokenizer(spark)
    schema = "shard int, ord string, doc_id long, title string, content string"
    jsonl.append_files(spark.createDataFrame([(0, "a", 1, "t", "texte"), (1, "b", 2, "t", "")], schema), path, 2)
    ingest.ingest_growing(spark, path, out, cp, tok, 8).awaitTermination()
    jsonl.append_files(spark.createDataFrame([(0, "c", 3, "t", "xtextex")], schema), path, 2)
    ingest.ingest_growing(spark, path, out, cp, tok, 8).awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert [(r["shard"], r["chunk"]) for r in rows] == [(0, 0)]
    stream = [0, *(tok.pieces[c] for c in "texte"), 1, 0, *(tok.pieces[c] for c in "xtextex"), 1]
    assert rows[0]["x"] == stream[:8] and rows[0]["y"] == stream[1:9]


def test_a_batch_writes_only_the_shards_that_it_changes(spark):
    path, out, cp = fresh_path(spark, "in"), fresh_path(spark, "counts"), fresh_path(spark, "cp")
    tok = tokenizer(spark)
    placed = shards.assign_shards(corpus.articles(raw(spark, 80)), 4)

    def run(part):
        jsonl.append_files(part, path, 4)
        ingest.running_counts(spark, path, out, cp, tok, 100).awaitTermination()
        return {r["shard"]: (r["n_docs"], r["n_tokens"]) for r in ingest.latest_counts(spark, out).collect()}

    first = run(placed.where("doc_id % 2 = 0"))
    second = run(placed.where("doc_id % 2 = 1 and shard = 2"))
    assert {s for s in first if first[s] != second[s]} == {2} and set(second) == set(first)
    written = [n for n in folder_names(spark, out) if n.startswith("batch=")]
    assert spark.read.parquet(f"{out}/{max(written)}").count() == 1
    ingest.merge_counts(spark, out)
    assert folder_names(spark, out) == [max(written).replace("batch", "merged")]
    third = run(placed.where("doc_id % 2 = 1 and shard <> 2"))
    assert third[2] == second[2] and sum(n for n, _ in third.values()) == 80
    ingest.merge_counts(spark, out)
    ingest.merge_counts(spark, out)
    assert {r["shard"]: (r["n_docs"], r["n_tokens"]) for r in ingest.latest_counts(spark, out).collect()} == third


def test_growing_ingest_holds_no_shard_and_replaces_a_batch(spark):
    """Lines meet by blocks of files, ends go from batch to batch, and a batch that runs again adds no row."""
    tok = tokenizer(spark)
    schema = "shard int, ord string, doc_id long, title string, content string"
    folder, out, cp = fresh_path(spark, "in"), fresh_path(spark, "out"), fresh_path(spark, "cp")
    stream = []
    for k in range(3):
        rows = [(0, f"{k}{i}", 10 * k + i, "t", "texte" * i) for i in range(4)]
        jsonl.append_files(spark.createDataFrame(rows, schema), folder, 1)
        stream += [t for r in rows for t in (0, *(tok.pieces[c] for c in r[4]), 1)]
        ingest.ingest_growing(spark, folder, out, cp, tok, 8).awaitTermination()
    want = [(i, stream[8 * i : 8 * i + 8], stream[8 * i + 1 : 8 * i + 9]) for i in range(len(stream) // 8 - 1)]
    assert [tuple(r) for r in spark.read.parquet(out).select("chunk", "x", "y").orderBy("chunk").collect()] == want
    # The ends after the last batch: the next chunk and all tokens from its start on.
    end = spark.read.parquet(f"{cp}/open_ends/2").first()
    assert (end["chunk"], end["ids"]) == (len(want), stream[8 * len(want) :])
    # The last batch runs again, from the ends of the batch before it.
    commit = next(p for p in Path(f"{cp}/commits").iterdir() if p.name == "2")
    commit.unlink()
    Path(f"{cp}/commits/.2.crc").unlink(missing_ok=True)
    ingest.ingest_growing(spark, folder, out, cp, tok, 8).awaitTermination()
    assert [tuple(r) for r in spark.read.parquet(out).select("chunk", "x", "y").orderBy("chunk").collect()] == want
    # Nothing of the stream's state is a Python task that takes a shard's rows.
    assert not hasattr(ingest, "PackShard")
