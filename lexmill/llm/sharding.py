"""Shards of near-equal size by sampled splitters, in DataFrame functions only."""

from __future__ import annotations

import heapq
import json

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexmill.llm.common import text_or_empty
from lexmill.session import write_table

#: Key ranges per shard at least, and rows of a range on average at most.
RANGES_PER_SHARD = 16
ROWS_PER_RANGE = 1_000_000
#: Sampled keys per range.
DRAWS = 32
SEED = 17


def _uniform(*columns: str) -> Column:
    """A repeatable number in [0, 1) of the columns' values."""
    return F.pmod(F.xxhash64(*columns, F.lit(SEED)), F.lit(1 << 30)) / float(1 << 30)


def _below(points: Column, key: Column) -> Column:
    """How many of the sorted points are at most ``key``."""
    return F.size(F.filter(points, lambda p: p <= key))


def shard_records(
    docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: ``id_col, size, text_crc32, shard, slot``; shards have equal bytes.

    Size is the UTF-8 bytes of the text plus 8. Records are ordered by (content hash, id). A
    size-weighted sample of keys, of a size that depends on the number of ranges only, gives
    quantile boundaries; records are exchanged by the ranges between them, ranges that counting shows to
    be overfull are subdivided by a denser sample, and running sums are taken inside each range.

    Equal texts stay in one shard unless they fill more than a shard. Groups that fill more than a
    range, at most as many as there are ranges, are given homes first, the largest to the emptiest shard;
    their records spread over ranges by id all the same. All else fills up the shards in order, a
    group by its middle and a record of a group larger than a shard by its own. Hence, if no shard is filled by
    homes alone, each border misses its place by half a group of at most a range's share, or half a record.
    Slots count a shard's records from 0 without gaps, in the order of (content hash, id). Null texts are
    empty; null ids sort first; repeated rows take neighbouring slots; no rows give no rows. Other
    columns are not read.
    """
    spark = docs.sparkSession
    body = text_or_empty(text_col)
    narrow, _ = write_table(
        docs.select(
            F.col(id_col).cast("long").alias("id"),
            (F.octet_length(body) + F.lit(8)).cast("long").alias("size"),
            F.crc32(body).alias("crc"),
            F.xxhash64(body).alias("h"),
        ),
        "shard-keys",
    )
    total, rows = narrow.agg(F.sum("size"), F.count(F.lit(1))).first()
    total, rows = total or 0, rows or 0
    if not rows:
        return narrow.select(
            F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"),
            F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"),
        )
    n_ranges = max(n_shards * RANGES_PER_SHARD, -(-rows // ROWS_PER_RANGE))
    share = max(1, total // n_ranges)

    # At most n_ranges groups can be that large.
    large = narrow.groupBy("h").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > share).collect()
    pinned, bounds = _homes({r["h"]: r["bytes"] for r in large}, total, n_shards)
    listed = json.dumps([{"h": r["h"], "home": pinned.get(r["h"])} for r in large])
    homes = spark.range(1).select(F.inline(F.from_json(F.lit(listed), "array<struct<h: bigint, home: int>>")))
    keyed = narrow.join(F.broadcast(homes.withColumn("large", F.lit(True))), "h", "left").select(
        "id", "size", "crc", "h", "home", F.coalesce("large", F.lit(False)).alias("large")
    )
    key = F.struct(F.col("h"), F.when(F.col("large"), F.col("id")).alias("id"))

    # Sampled splitters, then a second, denser sample of the ranges that hold more than twice their share.
    points = _points(_drawn(keyed, key, n_ranges * DRAWS / max(1, total)), {0: n_ranges})
    ranged, _ = write_table(keyed.withColumn("range", _range(points, key)), "shard-ranges")
    held = ranged.groupBy("range").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"))
    full = held.where((F.col("b") > 2 * share) | (F.col("n") > 2 * ROWS_PER_RANGE)).collect()
    parts = {r["range"]: 2 * max(-(-r["b"] // share), -(-r["n"] // ROWS_PER_RANGE)) for r in full}
    if parts:
        # What cannot be subdivided further, a record larger than a range, takes no more splitters.
        overfull = ranged.where(F.col("range").isin(list(parts)))
        points = sorted({*points, *_points(_drawn(overfull, key, 4 * n_ranges * DRAWS / max(1, total)), parts)}, key=_order)
        ranged, _ = write_table(keyed.withColumn("range", _range(points, key)), "shard-ranges")

    # What lies before each range outside groups with homes: a table of one row per range.
    free = F.when(F.col("home").isNull(), F.col("size")).otherwise(0)
    sums = ranged.groupBy("range").agg(F.sum(free).alias("b"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("range", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("bytes_before"))
    inside = Window.partitionBy("range").orderBy("h", "id", "size", "crc").rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy("range").orderBy("h").rangeBetween(Window.unboundedPreceding, -1)
    placed = ranged.select(
        "*",
        F.coalesce(F.sum(free).over(inside), F.lit(0)).alias("own_start"),
        F.coalesce(F.sum(free).over(group), F.lit(0)).alias("group_start"),
        F.sum("size").over(Window.partitionBy("range", "h")).alias("group_size"),
    ).join(F.broadcast(starts), "range")
    middle = F.col("bytes_before") + F.when(F.col("large"), F.col("own_start") + F.col("size") / 2).otherwise(
        F.col("group_start") + F.col("group_size") / 2
    )
    sharded = placed.withColumn(
        "shard", F.coalesce("home", _below(F.array(*map(F.lit, bounds)), middle)).cast("int")
    )
    row = Window.partitionBy("range", "shard").orderBy("h", "id", "size", "crc")
    sharded, _ = write_table(
        sharded.select("id", "size", "crc", "range", "shard", F.row_number().over(row).alias("row")), "shard-rows"
    )
    # Rows of a shard in earlier ranges: a shard meets each range at most once here.
    earlier = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    first = sharded.groupBy("range", "shard").agg(F.count(F.lit(1)).alias("n")).select(
        "range", "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first")
    )
    return sharded.join(first, ["range", "shard"]).select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        "shard",
        (F.col("first") + F.col("row") - 1).alias("slot"),
    )


def _homes(large: dict[int, int], total: int, n_shards: int) -> tuple[dict[int, int], list[int]]:
    """Homes of the groups that fit a shard, and the borders between shards along the bytes of all else.

    All else fills the shards up to one level, which those that homes alone fill beyond it do not share.
    """
    width = -(-total // n_shards)
    loads = [(0, k) for k in range(n_shards)]
    home = {}
    for size, h in sorted(((size, h) for h, size in large.items() if size <= width), key=lambda g: (-g[0], g[1])):
        load, k = loads[0]
        heapq.heapreplace(loads, (load + size, k))
        home[h] = k
    rest, by_load = total - sum(large[h] for h in home), sorted(loads)
    level = filled = 0
    for n, (load, _) in enumerate(by_load, 1):
        filled += load
        level = (rest + filled) / n
        if n == n_shards or level <= by_load[n][0]:
            break
    room = [max(0.0, level - load) for load, _ in sorted(loads, key=lambda g: g[1])]
    return home, [int(sum(room[: k + 1])) for k in range(n_shards - 1)]


def _drawn(keyed: DataFrame, key: Column, rate: float) -> DataFrame:
    """Keys drawn in proportion to their size, with what each stands for; ``range`` if there is one."""
    chance = F.least(F.lit(1.0), F.col("size") * F.lit(rate))
    held = F.col("range") if "range" in keyed.columns else F.lit(0)
    return keyed.where(_uniform("id", "h") < chance).select(
        held.alias("range"), key.alias("key"), (F.col("size") / chance).alias("weight")
    )


def _points(drawn: DataFrame, parts: dict[int, int]) -> list[tuple]:
    """Sorted quantiles of the drawn keys: of each range so many as ``parts`` says."""
    along = Window.partitionBy("range").orderBy("key")  # bounded by the sample
    n = F.element_at(F.from_json(F.lit(json.dumps(parts)), "map<string, bigint>"), F.col("range").cast("string"))
    quantile = F.floor(F.sum("weight").over(along) * n / F.sum("weight").over(Window.partitionBy("range")))
    cuts = drawn.select("range", "key", quantile.alias("q")).groupBy("range", "q").agg(F.min("key").alias("key"))
    return sorted({(r.key.h, r.key.id) for r in cuts.where("q > 0").collect()}, key=_order)


def _order(point: tuple) -> tuple:
    return point[0], point[1] is not None, point[1] or 0


def _range(points: list[tuple], key: Column) -> Column:
    """How many of the points are at most a record's key, looked up in two steps."""
    if not points:
        return F.lit(0)
    step = int(len(points) ** 0.5)
    blocks = [points[i : i + step] for i in range(0, len(points), step)]
    heads = F.array(*[_point(b[0]) for b in blocks])
    inner = F.array(*[F.array(*[_point(p) for p in b]) for b in blocks])
    block = F.greatest(_below(heads, key), F.lit(1))
    return (block - 1) * step + _below(F.element_at(inner, block), key)


def _point(p: tuple) -> Column:
    return F.struct(F.lit(p[0]).cast("long").alias("h"), F.lit(p[1]).cast("long").alias("id"))
