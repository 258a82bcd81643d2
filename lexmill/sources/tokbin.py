"""Raw uint16 token files as a Spark data source named ``tokbin``.

Write: ``df.write.format("tokbin").option("shards", n).mode("append").save(folder)`` with rows ``shard, part, tokens``
grouped and ordered by shard and part inside each task. A shard's stream is its parts in order: the file
``shard_{i}.bin`` where there is one, else ``shard_{i}.part_{k}.bin``. A manifest names the parts of all shards, empty
ones included. Read: ``spark.read.format("tokbin").load(folder)`` gives blocks of consecutive tokens, of the manifest's
shards or, without one, of all ``shard_{i}.bin``. Folders may be any location that Arrow file systems reach.
"""

from __future__ import annotations

import json
import math
import re
import uuid

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)

from lexmill import schemas
from lexmill.operators.packing import narrow_ids

BLOCK_TOKENS = 4_096
SPLIT_BYTES = 64 * 1024 * 1024
TOKEN_BYTES = 2
NAME = re.compile(r"shard_(\d+)\.bin$")
MANIFEST = "_manifest.json"
PLACE_DIGITS = 12  # hexadecimal digits of an order key that place a document in its shard


def open_folder(location: str):
    """Arrow file system and path of a URI or an absolute path; Hadoop's names of S3 are understood."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", location))


def read_manifest(location: str) -> dict[int, list[tuple[str, int, int]]]:
    """Per shard the parts ``(path, start, tokens)`` in order."""
    from pyarrow import fs

    files, folder = open_folder(location)
    if files.get_file_info(f"{folder}/{MANIFEST}").is_file:
        with files.open_input_file(f"{folder}/{MANIFEST}") as f:
            shards = json.loads(f.read())["shards"]
        return {int(s): [(f"{folder}/{name}", start, n) for name, start, n in parts] for s, parts in shards.items()}
    found = {}
    for info in files.get_file_info(fs.FileSelector(folder)):
        m = NAME.search(info.path)
        if m and info.is_file:
            found[int(m[1])] = [(info.path, 0, info.size // TOKEN_BYTES)]
    if not found:
        raise ValueError(f"no token files in {location}")
    return found


class StreamSplit(InputPartition):
    """Tokens ``first`` to ``stop`` of a shard's stream, and the parts that hold them."""

    def __init__(self, shard: int, parts: list[tuple[str, int, int]], first: int, stop: int):
        self.shard, self.first, self.stop = shard, first, stop
        self.parts = [p for p in parts if p[1] < stop and p[1] + p[2] > first]


class Written(WriterCommitMessage):
    def __init__(self, made: list[tuple[str, int, int, int]]):
        self.made = made  # staged path, shard, part, tokens


class TokenReader(DataSourceReader):
    """Cuts every stream into ranges of whole blocks, so one large shard has many readers.

    Conditions on ``shard`` and ``start`` leave only the ranges that may fulfil them; Spark checks the rows again.
    """

    def __init__(self, options: dict):
        self.location = options["path"]
        self.block = int(options.get("blocktokens", BLOCK_TOKENS))
        self.shards: set[int] | None = None
        self.bounds = {"shard": [-math.inf, math.inf], "start": [-math.inf, math.inf]}

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in self.bounds:
                self._narrow(column, f)
            yield f

    def _narrow(self, column: str, f) -> None:
        low, high = self.bounds[column]
        if isinstance(f, In) and column == "shard":
            wanted = set(f.value)
            self.shards = wanted if self.shards is None else self.shards & wanted
        elif isinstance(f, EqualTo):
            self.bounds[column] = [max(low, f.value), min(high, f.value)]
        elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
            self.bounds[column] = [max(low, f.value + isinstance(f, GreaterThan)), high]
        elif isinstance(f, (LessThan, LessThanOrEqual)):
            self.bounds[column] = [low, min(high, f.value - isinstance(f, LessThan))]

    def partitions(self):
        step = max(self.block, SPLIT_BYTES // TOKEN_BYTES // self.block * self.block)
        (low, high), (first, last) = self.bounds["shard"], self.bounds["start"]
        found = []
        for shard, parts in sorted(read_manifest(self.location).items()):
            if not low <= shard <= high or (self.shards is not None and shard not in self.shards):
                continue
            n = sum(p[2] for p in parts)
            found += [
                StreamSplit(shard, parts, lo, min(lo + step, n))
                for lo in range(0, n, step) if lo <= last and min(lo + step, n) > first
            ]
        return found or [StreamSplit(-1, [], 0, 0)]

    def read(self, split: StreamSplit):
        import numpy as np
        import pyarrow as pa

        files, _ = open_folder(self.location)
        rows = 256
        for lo in range(split.first, split.stop, rows * self.block):
            hi = min(lo + rows * self.block, split.stop)
            pieces = []
            for path, start, n in split.parts:
                a, b = max(lo, start), min(hi, start + n)
                if a < b:
                    with files.open_input_file(path) as f:
                        f.seek((a - start) * TOKEN_BYTES)
                        pieces.append(np.frombuffer(f.read((b - a) * TOKEN_BYTES), dtype="<u2"))
            ids = np.concatenate(pieces).astype(np.int32)
            starts = np.arange(lo, hi, self.block, dtype=np.int64)
            ends = np.append(starts - lo, hi - lo).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(starts), split.shard, dtype=np.int32)),
                    pa.array(starts),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(ids)),
                ],
                names=["shard", "start", "tokens"],
            )


class TokenWriter(DataSourceArrowWriter):
    """Streams each part to a file of its own attempt; commit gives the files their names and writes the manifest."""

    def __init__(self, options: dict):
        self.location = options["path"]
        self.n_shards = int(options["shards"])
        self.job = uuid.uuid4().hex

    def write(self, iterator):
        import numpy as np

        files, folder = open_folder(self.location)
        stage = f"{folder}/_attempt-{self.job}-{uuid.uuid4().hex}"
        made, current, out = [], None, None
        for batch in iterator:
            shards, parts = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("shard", "part"))
            lists = batch.column(batch.schema.get_field_index("tokens"))
            for i, key in enumerate(zip(shards, parts)):
                if key != current:
                    if out is not None:
                        out.close()
                    else:
                        files.create_dir(stage, recursive=True)
                    if any(tuple(m[1:3]) == key for m in made):
                        raise ValueError("rows of one part must be next to each other")
                    path = f"{stage}/{key[0]}-{key[1]}"
                    out, current = files.open_output_stream(path), key
                    made.append([path, *key, 0])
                ids = lists[i].values
                if ids is not None and len(ids):
                    out.write(np.asarray(ids).astype("<u2").tobytes())
                    made[-1][3] += len(ids)
        if out is not None:
            out.close()
        return Written([tuple(m) for m in made])

    def commit(self, messages):
        files, folder = open_folder(self.location)
        made = sorted((shard, part, path, n) for m in messages if m for path, shard, part, n in m.made)
        if len({row[:2] for row in made}) != len(made):
            raise ValueError("two tasks wrote the same part")
        shards: dict[int, list] = {s: [] for s in range(self.n_shards)}
        for shard, part, path, n in made:
            shards[shard].append((part, path, n))
        manifest = {}
        for shard, parts in shards.items():
            start, manifest[shard] = 0, []
            for part, path, n in parts:
                name = f"shard_{shard}.bin" if len(parts) == 1 else f"shard_{shard}.part_{part}.bin"
                files.move(path, f"{folder}/{name}")
                manifest[shard].append((name, start, n))
                start += n
        aside = f"{folder}/_attempt-{self.job}-manifest"
        files.create_dir(aside)
        with files.open_output_stream(f"{aside}/{MANIFEST}") as f:
            f.write(json.dumps({"shards": manifest}).encode())
        files.move(f"{aside}/{MANIFEST}", f"{folder}/{MANIFEST}")
        self._drop_stages()

    def abort(self, messages):
        self._drop_stages()

    def _drop_stages(self):
        # Also those of attempts that failed or ran twice.
        from pyarrow import fs

        files, folder = open_folder(self.location)
        for info in files.get_file_info(fs.FileSelector(folder)):
            if f"/_attempt-{self.job}-" in info.path:
                files.delete_dir(info.path)


class TokbinSource(DataSource):
    @classmethod
    def name(cls):
        return "tokbin"

    def schema(self):
        return schemas.TOKEN_BLOCKS

    def reader(self, schema):
        return TokenReader(self.options)

    def writer(self, schema, overwrite):
        return TokenWriter(self.options)


def part_in_shard(ord_key, shard, n_shards: int, writers: int):
    """The part of a shard that a document belongs to, never decreasing along the hash order.

    Shards are almost equal ranges of that order, so parts are almost equal ranges of the shard.
    """
    place = F.conv(F.substring(ord_key, 1, PLACE_DIGITS), 16, 10).cast("double") / float(16**PLACE_DIGITS)
    part = F.floor((F.coalesce(place, F.lit(0.0)) * n_shards - shard) * writers)
    return F.least(F.greatest(part, F.lit(0)), F.lit(writers - 1)).cast("int")


def write_token_files(
    tokens: DataFrame, folder: str, n_shards: int, overwrite: bool = False, writers: int | None = None
) -> None:
    """Token files of ``shard, ord, doc_id, tokens``, and the manifest of all ``n_shards`` shards.

    ``writers`` tasks write a shard, each a range of it; by default as many as
    the cluster has cores for each shard. The folder must be new or empty unless ``overwrite`` is given.
    """
    from pyarrow import fs

    spark = tokens.sparkSession
    spark.dataSource.register(TokbinSource)
    writers = writers or max(1, spark.sparkContext.defaultParallelism // n_shards)
    files, path = open_folder(folder)
    known = files.get_file_info(path).type != fs.FileType.NotFound
    if known and files.get_file_info(fs.FileSelector(path)):
        if not overwrite:
            raise FileExistsError(f"{folder} is not empty")
        files.delete_dir_contents(path)
    files.create_dir(path, recursive=True)
    part = part_in_shard(F.col("ord").cast("string"), F.col("shard"), n_shards, writers)
    (
        tokens.withColumn("part", part)
        .repartitionById(n_shards * writers, F.col("shard") * writers + F.col("part"))
        .sortWithinPartitions("shard", "part", "ord", "doc_id")
        .select("shard", "part", narrow_ids(F.col("tokens")).alias("tokens"))
        .write.format("tokbin")
        .option("shards", n_shards)
        .mode("append")
        .save(folder)
    )


def shard_lengths(spark, folder: str) -> DataFrame:
    """``shard, stream_len`` of all shards of the manifest, empty ones included."""
    rows = [(shard, sum(p[2] for p in parts)) for shard, parts in sorted(read_manifest(folder).items())]
    return spark.createDataFrame(rows, "shard int, stream_len bigint")


def read_token_files(spark, folder: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``shard, start, tokens``: blocks of the streams, ``start`` counted in tokens.

    Filters on ``shard`` and ``start`` reach the files.
    """
    spark.dataSource.register(TokbinSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("tokbin").option("blockTokens", block_tokens).load(folder)
