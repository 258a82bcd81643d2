"""Similarity join of word shingles: chosen paths find candidates, whole sets decide."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from lexmill.llm.common import columns, map_rows, text_or_empty
from lexmill.llm.graph import components
from lexmill.session import drop_table, task_count, write_table

#: Words of a shingle, and the similarity of a link.
SHINGLE = 5
SIMILARITY = 0.8
#: Probability that a link at the threshold becomes a candidate.
RECALL = 0.999
#: Sampled minima of each set: the tokens that paths are made of, and their lowest bytes for sketches.
TOKENS = 128
#: Members of a bucket that are compared all with all; larger buckets are split further.
SMALL = 512
#: Longest path. What is still large then is one group of candidates.
DEPTH = 12
#: Children that a pair at the threshold shares on average in a bucket below a root. More need fewer runs, but
#: texts with a share of common tokens over 0.8 / BRANCHING then multiply on the way down.
BRANCHING = 1.5
#: Part of a bucket's members that must resemble its pivot if the bucket is to be one group of candidates:
#: splitting near copies gains nothing, while texts that only share a passage part on other tokens.
ALIKE = 0.5
#: Standard deviations below the threshold at which a sketch still passes.
SLACK = 4.0
#: Sets, and shingles, of a block in the exact comparison.
BLOCK_SETS = 512
BLOCK_SHINGLES = 2_000_000
#: Tokens that are multiplied at a time.
COLUMNS = 8_192
#: Most rows of hashes and ids that are broadcast; what is larger is joined by an exchange.
BROADCAST_ROWS = 1_000_000
#: Most pivots whose tokens are broadcast.
BROADCAST_PIVOTS = 20_000
#: Word hashes that a worker remembers.
REMEMBERED = 500_000
MIX = np.uint64(0x9E3779B97F4A7C15)
#: The multipliers and shifts of the minima are drawn from this seed.
SEED = 20_240_501


class _Words(dict):
    """Hashes of words, up to a bound."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < REMEMBERED:
            self[word] = value
        return value


_words = _Words()


def shingles(text: str, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the windows of ``width`` words.

    Words are runs other than the six ASCII white-space characters. A text of fewer words is one
    window; a text without words has none.
    """
    words = text.encode("utf-8", "surrogatepass").split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    n = len(words) - width + 1
    code = np.full(n, width, np.uint64)
    for k in range(width):
        code = (code ^ h[k : k + n]) * MIX
        code ^= code >> np.uint64(29)
    return np.unique(code)


_rng = np.random.default_rng(SEED)
_TIMES = _rng.integers(1, 1 << 63, (TOKENS, 1), np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _rng.integers(0, 1 << 63, (TOKENS, 1), np.uint64)


def minima(codes: np.ndarray) -> np.ndarray:
    """The smallest of ``TOKENS`` hashes over a set; two sets share one with the chance of their similarity."""
    least = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(codes), 1024):
        hashed = _TIMES * codes[None, at : at + 1024] + _PLUS
        hashed ^= hashed >> np.uint64(31)
        hashed *= MIX
        np.minimum(least, hashed.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def runs_needed(depth: int = DEPTH, recall: float = RECALL) -> int:
    """Runs until a link at the threshold is found with probability ``recall``, for paths of any length up to ``depth``.

    A root samples each token with chance ``1 / (similarity * TOKENS)``, so a pair at the threshold
    shares one child on average; a node below samples ``BRANCHING`` times as many. The pair shares a
    path of length d below a root's child unless all branches die: ``q(0) = 0, q(d) = exp(B * (q(d - 1) - 1))``.
    As the branches outgrow their deaths, the number of runs hardly depends on the length.
    """
    dead = 0.0
    for _ in range(depth - 1):
        dead = math.exp(BRANCHING * (dead - 1))
    return math.ceil(math.log(1 - recall) / (dead - 1))


def sets_of(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``(id, h)`` of every row, and ``(key, h, rep_id, copies, n, tokens)`` of every distinct text."""
    source = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("body")).select(
        "id", F.unhex(F.md5("body")).alias("h"), "body"
    )
    schema = columns(id="long", h="binary", n="long", tokens="ints")

    def make():
        def apply(ids, hashes, texts):
            sets = [shingles(t) for t in texts]
            return {"id": ids, "h": hashes, "n": [len(s) for s in sets],
                    "tokens": [minima(s) if len(s) else None for s in sets]}

        return apply

    schema["id"].dataType = source.schema["id"].dataType
    rows, _ = write_table(map_rows(source, schema, make), "shingle-minima")
    texts = rows.groupBy("h").agg(
        F.min("id").alias("rep_id"), F.count(F.lit(1)).alias("copies"),
        F.first("n").alias("n"), F.first("tokens").alias("tokens"),
    )
    # Numbers are fixed once the table is written.
    keyed, _ = write_table(texts.select(F.monotonically_increasing_id().alias("key"), "*"), "texts")
    return rows.select("id", "h"), keyed


def _children(node, tokens, depth: int):
    """The buckets below a node: one for each token place that the node samples."""
    chance = int((1 << 20) * (BRANCHING if depth else 1) / (SIMILARITY * TOKENS))
    places = F.filter(
        F.sequence(F.lit(0), F.lit(TOKENS - 1)),
        lambda i: F.pmod(F.xxhash64(node, i, F.lit(depth)), F.lit(1 << 20)) < chance,
    )
    return F.explode(F.transform(places, lambda i: F.xxhash64(node, i, F.get(tokens, i)))).alias("node")


def _grouped(batches, keys: int) -> Iterator[list[tuple]]:
    """Runs of rows with equal leading columns, from sorted batches."""
    group, at = [], None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:keys] != at:
                if group:
                    yield group
                group, at = [], row[:keys]
            group.append(row)
    if group:
        yield group


class _Forest:
    """Disjoint sets of small numbers."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.parent[max(i, j)] = min(i, j)
        return i != j


def _compare_sketches(buckets: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` between members of a small bucket whose sketches agree enough; a forest per bucket."""
    schema = columns(a="long", b="long")
    target = to_arrow_schema(schema)
    least = _agreement()

    def run(batches):
        a, b = [], []
        for group in _grouped(batches, 1):
            keys = [row[1] for row in group]
            sketch = np.frombuffer(b"".join(row[2] for row in group), np.uint8).reshape(len(keys), TOKENS)
            forest = _Forest(len(keys))
            for i in range(len(keys) - 1):
                for j in (np.flatnonzero((sketch[i + 1 :] == sketch[i]).sum(axis=1) >= least) + i + 1).tolist():
                    if forest.join(i, j):
                        a.append(keys[i])
                        b.append(keys[j])
            if len(a) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=target)
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=target)

    return buckets.mapInArrow(run, schema)


def _sketch(tokens):
    """The lowest byte of every token."""
    return F.unhex(F.array_join(F.transform(tokens, lambda t: F.lpad(F.hex(t.bitwiseAND(F.lit(255))), 2, "0")), ""))


def _agreement() -> float:
    """Tokens in which two texts agree at least if they may be linked."""
    return TOKENS * SIMILARITY - SLACK * math.sqrt(TOKENS * SIMILARITY * (1 - SIMILARITY))


def _near_pivot(large: DataFrame, tokens: DataFrame) -> tuple[DataFrame, str]:
    """``node, key, pivot, tokens, alike``: whether most members of the large bucket resemble its pivot.

    Every member's tokens are joined once; of pivots there is one to a large bucket.
    """
    pivots, pivots_path = write_table(
        tokens.join(large.select(F.col("pivot").alias("key")).distinct(), "key").select(
            F.col("key").alias("pivot"), F.col("tokens").alias("pivot_tokens")
        ),
        "pivots",
    )
    few = pivots.count() <= BROADCAST_PIVOTS
    agree = F.size(F.filter(F.zip_with("tokens", "pivot_tokens", lambda s, t: s == t), lambda same: same))
    near, path = write_table(
        large.join(tokens, "key").join(F.broadcast(pivots) if few else pivots, "pivot").select(
            "node", "key", "pivot", "tokens", (agree >= _agreement()).alias("near")
        ),
        "large-buckets",
    )
    drop_table(large.sparkSession, pivots_path)
    share = near.groupBy("node").agg((F.avg(F.col("near").cast("int")) >= ALIKE).alias("alike"))
    return near.join(share, "node").select("node", "key", "pivot", "tokens", "alike"), path


def candidates(texts: DataFrame, recall: float = RECALL) -> DataFrame:
    """Edges ``(a, b)`` that connect all texts whose link was found in some run.

    All runs walk down together: the rows of a level are (bucket, text). A bucket with one member
    ends, a small one is compared by sketches, and a larger one is split by the tokens that it
    samples, unless most members resemble its pivot. Below the first level only the texts of split
    buckets are read.
    """
    spark = texts.sparkSession
    parts = task_count(spark)
    pool = texts.where("tokens is not null").select("key", "tokens")
    found, paths = [], []

    def kept(df: DataFrame, label: str) -> DataFrame:
        table, path = write_table(df, label)
        paths.append(path)
        return table

    runs = F.sequence(F.lit(0), F.lit(runs_needed(DEPTH, recall) - 1))
    roots = F.explode(F.transform(runs, lambda r: F.xxhash64(r, F.lit(SEED)))).alias("root")
    level = pool.select("key", "tokens", roots).select("key", _children(F.col("root"), F.col("tokens"), 0))
    for d in range(1, DEPTH + 1):
        rows, rows_path = write_table(level, "buckets")
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("members"), F.min("key").alias("pivot"))
        members, members_path = write_table(rows.join(sizes.where("members > 1"), "node"), "shared-buckets")
        drop_table(spark, rows_path)
        small = members.where(F.col("members") <= SMALL).select("node", "key").join(
            pool.select("key", _sketch(F.col("tokens")).alias("sketch")), "key"
        )
        small = small.select("node", "key", "sketch").repartition(parts, "node").sortWithinPartitions("node", "key")
        found.append(kept(_compare_sketches(small).distinct(), "candidates"))
        large = members.where(F.col("members") > SMALL)
        if large.isEmpty():
            drop_table(spark, members_path)
            break
        judged, judged_path = _near_pivot(large, pool)
        whole = F.lit(True) if d == DEPTH else F.col("alike")
        found.append(kept(judged.where(whole).select(F.col("key").alias("a"), F.col("pivot").alias("b")), "candidates"))
        split = judged.where(~whole)
        drop_table(spark, members_path)
        if d == 1:
            pool = kept(split.select("key", "tokens").dropDuplicates(["key"]), "crowded-texts")
        level = kept(split.select("key", _children(F.col("node"), F.col("tokens"), d)), "children")
        drop_table(spark, judged_path)
        if level.isEmpty():
            break
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    edges, _ = write_table(edges.distinct(), "candidate-edges")
    for path in paths:
        drop_table(spark, path)
    return edges


def similar_pairs(sets: list[np.ndarray]) -> np.ndarray:
    """A square of truth: whether two sets have at least the similarity; exact counts of shared codes."""
    k = len(sets)
    sizes = np.array([len(s) for s in sets])
    if k == 2:
        shared = np.zeros((2, 2))
        shared[0, 1] = shared[1, 0] = len(np.intersect1d(*sets, assume_unique=True))
    else:
        owner = np.repeat(np.arange(k), sizes)
        codes = np.concatenate(sets)
        order = np.argsort(codes, kind="stable")
        codes, owner = codes[order], owner[order]
        new = np.append(True, codes[1:] != codes[:-1])
        token = np.cumsum(new) - 1
        often = np.bincount(token) > 1
        keep = often[token]
        token, owner = (np.cumsum(often) - 1)[token[keep]], owner[keep]
        shared = np.zeros((k, k), np.float64)
        total = int(often.sum())
        bounds = np.searchsorted(token, np.arange(0, total + COLUMNS, COLUMNS))
        for a, b in zip(bounds, bounds[1:]):
            here = np.zeros((k, COLUMNS), np.float32)
            here[owner[a:b], token[a:b] % COLUMNS] = 1
            shared += here @ here.T
    union = sizes[:, None] + sizes[None, :] - shared
    with np.errstate(invalid="ignore", divide="ignore"):
        alike = shared >= SIMILARITY * union - 1e-9
    np.fill_diagonal(alike, False)
    return alike & (union > 0)


def _compare_sets(groups: DataFrame) -> DataFrame:
    """``key, links, label`` for every member of a block pair; label is the smallest linked key there."""
    schema = columns(key="long", links="long", label="long")
    target = to_arrow_schema(schema)

    def run(batches):
        for group in _grouped(batches, 3):
            _, low, high = group[0][:3]
            members = {row[3]: row for row in group}  # a repeated row counts once
            keys = sorted(members)
            blocks = np.array([members[k][4] for k in keys])
            alike = similar_pairs([shingles(members[k][5]) for k in keys])
            if low != high:  # pairs inside a block belong to that block's own group
                counted = alike & (blocks[:, None] != blocks[None, :])
            else:
                counted = alike
            forest = _Forest(len(keys))
            for i, j in zip(*np.nonzero(np.triu(counted))):
                forest.join(int(i), int(j))
            out = [keys, counted.sum(axis=1).tolist(), [keys[forest.root(i)] for i in range(len(keys))]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], schema=target)

    return groups.mapInArrow(run, schema)


def similarity_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", recall: float = RECALL) -> DataFrame:
    """One row per input row: ``id_col, class_id, n_links, n_copies``.

    Two texts are linked when the Jaccard similarity of their sets of five-word shingles is at
    least 0.8. ``class_id`` is the smallest id of the texts connected by links, ``n_links`` the
    number of other texts linked to this one, ``n_copies`` the number of rows with this very text.

    Equal texts are one text from the start, so copies make no pairs. Chosen paths over sampled
    minima give candidate edges, whose components are then compared exactly with whole sets:
    a component beyond a block's bounds is cut into blocks, each pair of blocks is one group of
    bounded size, and only counts and a forest of links leave a group. Comparing a component is
    quadratic in its different texts, as is the number of their links. The recall holds for pairs
    at the threshold and grows with similarity; everything reported is exact.

    A null text is the empty text. A text of fewer than five words is one shingle; a text without
    words is linked to none. Null ids are ignored for ``class_id``, which is null if all are null;
    repeated rows are copies. No rows give no rows. Other columns are not read.
    """
    return _classes(docs, id_col, text_col, recall).select(F.col("id").alias(id_col), "class_id", "n_links", "n_copies")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", recall: float = RECALL) -> DataFrame:
    """One row of ``docs`` for each class of ``similarity_classes``: that with the smallest id.

    All columns stay as they are. Null ids come after all others; of rows with equal id and text
    an arbitrary one stays.
    """
    classes, _ = write_table(_classes(docs, id_col, text_col, recall), "similarity-classes")
    lowest = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h")).alias("lowest")
    order = classes.join(classes.groupBy("root").agg(lowest), "root")
    goes = ~(F.col("id").eqNullSafe(F.col("lowest.id")) & (F.col("h") == F.col("lowest.h")))
    # Rows that go are fewer than those that stay, and narrow: the documents are not exchanged for a bounded number.
    dropped, _ = write_table(
        order.where(goes).select(F.col("id").alias("__id"), F.col("h").alias("__gone")).distinct(), "near-copies"
    )
    few = dropped.count() <= BROADCAST_ROWS
    marked = docs.withColumn("__h", F.unhex(F.md5(text_or_empty(text_col))))
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__gone"))
    stay = marked.join(F.broadcast(dropped) if few else dropped, same, "left_anti")
    if not classes.groupBy("id", "h").count().where("count > 1").isEmpty():
        again = Window.partitionBy(id_col, "__h").orderBy("__h")
        stay = stay.withColumn("__row", F.row_number().over(again)).where("__row = 1")
    return stay.select(*[F.col(f"`{c}`") for c in docs.columns])


def _classes(docs: DataFrame, id_col: str, text_col: str, recall: float) -> DataFrame:
    """``similarity_classes`` with the text's hash ``h`` and the class's key ``root``."""
    spark = docs.sparkSession
    rows, texts = sets_of(docs, id_col, text_col)
    groups = components(candidates(texts, recall))
    member = texts.select("key", "h", "rep_id", "n").join(groups, F.col("key") == F.col("node")).drop("node")
    sized = member.groupBy("root").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("total")).select(
        "root", F.ceil(F.greatest(F.col("c") / BLOCK_SETS, F.col("total") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    )
    placed = member.join(sized, "root").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    body = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("body")).withColumn("h", F.unhex(F.md5("body")))
    placed, _ = write_table(placed.select("root", "blocks", "key", "block", "h", "rep_id"), "placed-texts")
    few = placed.count() <= BROADCAST_ROWS
    whole = body.join(F.broadcast(placed) if few else placed, "h").where(F.col("id").eqNullSafe(F.col("rep_id"))).select(
        "root", "blocks", "key", "block", "body"
    )
    dealt = whole.select("*", other).select(
        "root", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "key", "block", "body"
    )
    keys = ["root", "low", "high"]
    dealt = dealt.repartition(task_count(spark), *keys).sortWithinPartitions(*keys, "key")
    compared, _ = write_table(_compare_sets(dealt), "links")
    links = compared.groupBy("key").agg(F.sum("links").alias("n_links"))
    joined = components(compared.where("label < key").select(F.col("key").alias("a"), F.col("label").alias("b")))
    classed = texts.select("key", "h", "rep_id", "copies").join(joined, F.col("key") == F.col("node"), "left").select(
        "key", "h", "rep_id", "copies", F.coalesce("root", "key").alias("root")
    )
    smallest = classed.groupBy("root").agg(F.min("rep_id").alias("class_id"))
    labelled = classed.join(smallest, "root").join(links, "key", "left").select(
        "h", "root", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.col("copies").alias("n_copies")
    )
    return rows.join(labelled, "h")
