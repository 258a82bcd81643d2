"""Encoding by a dictionary of distinct words: each word is encoded once, its ids come back by a join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from lexmill.operators.bpe import BpeTokenizer, word_encoder
from lexmill.operators.vocab import WORD_START
from lexmill.session import drop_table, write_table

#: A word in more than one of so many (block, word) pairs is frequent. There are fewer such words than this.
FREQUENT = 10_000
#: Rows are gathered to blocks of so many bytes, or one row. The larger a block, the fewer pairs; a task holds one.
BLOCK_BYTES = 16_000_000
#: Bytes of ids, about half a million words, that a task holds before they leave it, block by block.
HELD_BYTES = 16_000_000


def marked_words(column: str):
    """Words as the encoder sees them: cut at U+0020 and at literal marks, each with the mark in front."""
    words = F.filter(F.split(F.col(column), " "), lambda w: w != "")
    return F.flatten(
        F.transform(words, lambda w: F.transform(F.split(w, WORD_START), lambda p: F.concat(F.lit(WORD_START), p)))
    )


def words_in_order(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Where the words of each text end among the words of all, beginning with 0, and the words without the mark."""
    cut = pc.split_pattern(pc.fill_null(texts, ""), " ")
    ends, words = cut.offsets.to_numpy(), cut.values
    there = pc.not_equal(words, "")
    if not pc.all(there).as_py():
        ends, words = np.append(0, np.cumsum(there, dtype=np.int32))[ends], words.filter(there)
    if pc.any(pc.match_substring(words, WORD_START)).as_py():
        cut = pc.split_pattern(words, WORD_START)
        ends, words = cut.offsets.to_numpy()[ends], cut.values
    return ends, words


def places_of_words(ends: np.ndarray, words: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Each word of a text once: the number of the text, the marked word, its places among the words of the text."""
    owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    coded = words.dictionary_encode()
    codes = np.asarray(coded.indices, np.int64)
    key = owner * max(1, len(coded.dictionary)) + codes
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.diff(key[order], prepend=-1))
    places = (np.arange(len(owner)) - ends[owner])[order]
    lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(order)), pa.int32()), pa.array(places, pa.int32()))
    marked = pc.binary_join_element_wise(WORD_START, coded.dictionary.cast(pa.string()), "")
    return owner[order[first]], marked.take(pa.array(codes[order[first]])), lists


def packed(table: pa.Table) -> pa.RecordBatch:
    """A table as one compressed value ``rows``."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["rows"])


def unpacked(rows: pa.BinaryScalar) -> pa.Table:
    return pa.ipc.open_stream(rows.as_buffer()).read_all()


def block_words(block: pa.Table, column: str) -> tuple[np.ndarray, pa.Array]:
    """``words_in_order`` of the texts of a block."""
    given, made = pa.Table.from_struct_array(block["row"])[column], block["text"]
    return words_in_order((given if made.null_count == len(made) else pc.coalesce(made, given)).combine_chunks())


def packed_rows(texts: DataFrame, column: str) -> DataFrame:
    """``rows``: the rows of each task in blocks of ``BLOCK_BYTES``, compressed, as tables ``row, text`` of whole rows
    and, where a text is not valid UTF-8, the text made so; moves no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            text = np.asarray(pc.fill_null(pc.binary_length(batch.column("row").field(column)), 0), np.int64)
            # Other columns count evenly.
            ends = np.cumsum(text + (batch.nbytes - int(text.sum())) // batch.num_rows)
            start = before = 0
            while start < batch.num_rows:
                stop = min(int(np.searchsorted(ends, before + BLOCK_BYTES - size)) + 1, batch.num_rows)
                held.append(batch.slice(start, stop - start))
                size += int(ends[stop - 1]) - before
                start, before = stop, int(ends[stop - 1])
                if size >= BLOCK_BYTES:
                    yield packed(pa.Table.from_batches(held))
                    held, size = [], 0
        if held:
            yield packed(pa.Table.from_batches(held))

    valid = F.when(~F.is_valid_utf8(column), F.make_valid_utf8(column)).alias("text")
    return texts.select(F.struct("*").alias("row"), valid).mapInArrow(run, "rows binary")


def word_places(rows: DataFrame, column: str, packed: str | None = None) -> DataFrame:
    """``_row, word, places``: each word of a row once, words as ``marked_words`` cuts them; moves no row.

    With ``packed``, the column that ``packed_rows`` made, a row is a block: its words are those of its texts in order.
    """
    schema = pa.schema([("_row", pa.int64()), ("word", pa.string()), ("places", pa.list_(pa.int32()))])

    def found(rows: pa.Array, ends: np.ndarray, words: pa.Array) -> pa.RecordBatch:
        owner, word, places = places_of_words(ends, words)
        return pa.RecordBatch.from_arrays([rows.take(pa.array(owner)), word, places], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if packed is None:
                yield found(batch.column(0), *words_in_order(batch.column(1)))
                continue
            for k in range(batch.num_rows):
                _, words = block_words(unpacked(batch.column(1)[k]), column)
                yield found(batch.column(0).slice(k, 1), np.array([0, len(words)]), words)

    given = F.make_valid_utf8(column).alias("text") if packed is None else packed
    return rows.select("_row", given).mapInArrow(run, "_row bigint, word string, places array<int>")


def encoded_words(words: DataFrame, tokenizer: BpeTokenizer) -> DataFrame:
    """``word, n, ids`` of distinct words ``word, n``, each encoded once."""
    piece_ids = tokenizer.piece_ids()
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_encoder(piece_ids, cache_size=0)
        for batch in batches:
            ids = [encode(w) for w in batch.column(0).to_pylist()]
            columns = [batch.column(0).cast(pa.string()), batch.column(1), pa.array(ids, schema.field("ids").type)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return words.select("word", "n").mapInArrow(run, "word string, n bigint, ids array<int>")


def ids_by_row(found: DataFrame) -> DataFrame:
    """``_row, places, sizes, ids``: rows ``_row, place, ids`` that a task holds together, one list for each ``_row``."""
    ints = pa.list_(pa.int32())
    schema = pa.schema([("_row", pa.int64()), ("places", ints), ("sizes", ints), ("ids", ints)])

    def gathered(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        rows = table["_row"].to_numpy()
        order = np.argsort(rows, kind="stable")
        table, rows = table.take(pa.array(order)), rows[order]
        first = np.flatnonzero(np.diff(rows, prepend=rows[0] - 1))
        ends = np.append(first, len(rows))
        ids = table["ids"].combine_chunks()
        sizes = pc.list_value_length(ids)
        flat_ends = np.append(0, np.cumsum(sizes.to_numpy()))[ends]
        lists = [
            pa.ListArray.from_arrays(pa.array(at, pa.int32()), values.cast(pa.int32()))
            for at, values in ((ends, table["place"].combine_chunks()), (ends, sizes), (flat_ends, ids.flatten()))
        ]
        return pa.RecordBatch.from_arrays([pa.array(rows[first]), *lists], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held += [batch] * bool(batch.num_rows)
            if sum(b.nbytes for b in held) >= HELD_BYTES:
                yield gathered(held)
                held = []
        if held:
            yield gathered(held)

    given = found.select("_row", "place", "ids")
    return given.mapInArrow(run, "_row bigint, places array<int>, sizes array<int>, ids array<int>")


def rows_with_ids(blocks: DataFrame, found: DataFrame, column: str, schema: StructType) -> DataFrame:
    """The rows of ``blocks`` with ``ids``, put together from ``found``, as ``ids_by_row`` gives it; exchanges both."""

    def encoded(block: pa.Table, found: pa.Table) -> pa.Table:
        table = unpacked(block["rows"][0])
        ends, words = block_words(table, column)
        # The words of a block are numbered in order of their first places.
        codes = words.dictionary_encode().indices
        places, sizes, ids = (pc.list_flatten(found[c]).combine_chunks() for c in ("places", "sizes", "ids"))
        starts = pa.array(np.append(0, np.cumsum(sizes.to_numpy())), pa.int32())
        by_code = pa.ListArray.from_arrays(starts, ids).take(pc.array_sort_indices(places))
        if len(by_code) != len(codes.unique()):
            raise ValueError("words and ids of a block do not match")
        by_word = by_code.take(codes)
        lists = pa.ListArray.from_arrays(pa.array(by_word.offsets.to_numpy()[ends], pa.int32()), by_word.values)
        return pa.Table.from_batches([packed(table.select(["row"]).append_column("ids", lists))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.column(0):
                for part in unpacked(block).to_batches():
                    yield pa.RecordBatch.from_arrays([*part.column("row").flatten(), part.column("ids")], schema.names)

    together = blocks.groupBy("_row").cogroup(found.groupBy("_row")).applyInArrow(encoded, "rows binary")
    return together.mapInArrow(rows, schema)


def dictionary_encode(texts: DataFrame, tokenizer: BpeTokenizer, column: str = "content") -> DataFrame:
    """``texts`` with ``ids``, equal to the map-only encoder's.

    Rows are gathered to blocks, compressed, and every block keeps its words once, with their places. The words
    are counted, encoded, and joined back: the frequent ones, fewer than ``FREQUENT`` by their definition, by
    broadcast, the others by an exchange in which no key holds more than one of ``FREQUENT`` rows. Of a word's
    places its first stands for all, as the words of a block are numbered by it. What comes back to a block
    is put together by place; a group is one block.

    A null or blank text has no ids. Rows may repeat.
    """
    spark = texts.sparkSession
    packed = packed_rows(texts, column).withColumn("_row", F.monotonically_increasing_id())
    blocks, _ = write_table(packed, "blocks")
    first = F.col("places")[0].alias("place")
    places = word_places(blocks, column, "rows").select("_row", "word", first)
    places, places_path = write_table(places, "word-places", compression="zstd")
    counted = places.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    known, known_path = write_table(encoded_words(counted, tokenizer), "word-ids", compression="zstd")
    total = places.count()
    often = F.col("n") * FREQUENT > total
    frequent = known.where(often).select("word", "ids", F.lit(True).alias("frequent"))
    by_frequent = places.join(F.broadcast(frequent), "word", "left")
    first = by_frequent.where("frequent").select("_row", "place", "ids")
    others = by_frequent.where("frequent is null").select("_row", "place", "word")
    second = others.join(known.where(~often).select("word", "ids"), "word").select("_row", "place", "ids")
    found, _ = write_table(ids_by_row(first.unionByName(second)), "block-ids", compression="zstd")
    drop_table(spark, places_path)
    drop_table(spark, known_path)
    columns = [StructField(f.name, f.dataType, True, f.metadata) for f in texts.schema]
    return rows_with_ids(blocks, found, column, StructType([*columns, StructField("ids", ArrayType(IntegerType()))]))
