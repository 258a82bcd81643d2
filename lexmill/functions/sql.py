"""The engine's functions under SQL names.

All but the byte-pair encoder and the packing of chunks are SQL functions, so the optimizer inlines them.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row, SparkSession, functions as F

from lexmill.functions.text import WHITESPACE, WHITESPACE_CLASS

FUNCTIONS = {
    "strip_text(t STRING) RETURNS STRING": f"btrim(t, '{WHITESPACE}')",
    "word_total(t STRING) RETURNS INT": (
        f"size(filter(split(t, r'[{WHITESPACE_CLASS}]+'), w -> w <> ''))"
    ),
    "shuffle_key(seed INT, doc_id BIGINT) RETURNS STRING": "md5(concat_ws(':', seed, doc_id))",
    "chunk_total(stream_len BIGINT, context INT) RETURNS BIGINT": (
        "greatest(stream_len div context - 1, 0)"
    ),
}
# Pieces of chunks that a document holds; group them by shard and chunk to pack a stream.
PIECES = """chunk_pieces(tokens ARRAY<INT>, o BIGINT, stream_len BIGINT, context INT)
RETURNS TABLE (chunk BIGINT, start BIGINT, ids ARRAY<INT>)
RETURN SELECT i, greatest(o, i * context),
  slice(tokens, int(greatest(o, i * context) - o + 1),
        int(least(o + size(tokens), i * context + context + 1) - greatest(o, i * context)))
FROM explode(sequence(greatest((o - 1) div context, 0), (o + size(tokens) - 1) div context)) AS c(i)
WHERE size(tokens) > 0 AND i < greatest(stream_len div context - 1, 0)"""


# Parts of a document that lie in blocks of ``width`` chunk numbers each, without the tokens that no chunk
# of the stream holds. A block ends with the first token of the next one, which its last chunk needs.
BLOCKS = """stream_blocks(tokens ARRAY<INT>, o BIGINT, stream_len BIGINT, context INT, width INT)
RETURNS TABLE (block BIGINT, start BIGINT, ids ARRAY<INT>)
RETURN SELECT block, start, slice(tokens, int(start - o + 1), int(stop - start)) FROM (
  SELECT i AS block, greatest(o, i * context * width) AS start,
         least(o + size(tokens), (i + 1) * context * width + 1,
               greatest(stream_len div context - 1, 0) * context + 1) AS stop
  FROM explode(sequence(greatest((o - 1) div (context * width), 0), (o + size(tokens) - 1) div (context * width))) AS c(i)
  WHERE size(tokens) > 0 AND stream_len div context > 1)
WHERE start < stop"""
# The same parts as an array: ``inline`` of it keeps each document in its row, where the lateral join that
# a table function becomes finds equal arguments, tokens included, by an exchange and joins them back.
BLOCK_PARTS = """block_parts(tokens ARRAY<INT>, o BIGINT, stream_len BIGINT, context INT, width INT)
RETURNS ARRAY<STRUCT<block: BIGINT, start: BIGINT, ids: ARRAY<INT>>>
RETURN transform(
  filter(
    transform(
      if(size(tokens) > 0 AND stream_len div context > 1,
         sequence(greatest((o - 1) div (context * width), 0), (o + size(tokens) - 1) div (context * width)),
         CAST(array() AS ARRAY<BIGINT>)),
      i -> named_struct('block', i, 'start', greatest(o, i * context * width),
                        'stop', least(o + size(tokens), (i + 1) * context * width + 1,
                                      greatest(stream_len div context - 1, 0) * context + 1))),
    p -> p.start < p.stop),
  p -> named_struct('block', p.block, 'start', p.start, 'ids', slice(tokens, int(p.start - o + 1), int(p.stop - p.start))))"""


@F.udtf(returnType="shard int, chunk bigint, x array<int>, y array<int>")
class PackChunks:
    """Next-token examples of one block of a stream, from its parts in order.

    Called as ``pack_chunks(TABLE(parts) PARTITION BY (shard, block) ORDER BY (start), context)``, with parts
    ``shard, block, start, ids`` from ``block_parts`` or ``stream_blocks``. Holds one chunk and one part at a time.
    """

    def __init__(self):
        self.held: list[int] = []
        self.chunk = -1

    def eval(self, part: Row, context: int) -> Iterator[tuple]:
        if self.chunk < 0:
            self.chunk = part["start"] // context
        held = self.held + part["ids"]
        at = 0
        while len(held) - at > context:
            window = held[at : at + context + 1]
            yield part["shard"], self.chunk, window[:-1], window[1:]
            self.chunk += 1
            at += context
        self.held = held[at:]


def register(spark: SparkSession, *tokenizers) -> None:
    """Make the functions known to the session.

    A byte-pair tokenizer brings ``bpe_encode`` and ``bpe_decode``, a character tokenizer ``char_encode``
    and ``char_decode``; the tokenizer of the latest call holds.
    """
    for signature, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {PIECES}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {BLOCKS}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {BLOCK_PARTS}")
    spark.udtf.register("pack_chunks", PackChunks)
    for tokenizer in tokenizers:
        for signature, body in tokenizer.sql_functions().items():
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
        for name, function in tokenizer.python_functions().items():
            spark.udf.register(name, function)
