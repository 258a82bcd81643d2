"""Passages that repeat across documents: sparse suffix arrays over content-selected positions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lexmill.llm.common import columns, map_rows, text_or_empty
from lexmill.llm.jaccard_join import MIX, _grouped, _words
from lexmill.session import task_count, write_table

#: Words of the shortest passage that counts.
LEAST = 50
#: Words that all suffixes of a group share, and positions of a window that keeps one. A passage of
#: ``LEAST`` words holds a whole window, so it keeps the same position in every document.
STEM = 20
WINDOW = LEAST - STEM + 1
#: Words of context that a suffix carries to the left and to the right. Kept positions are at most a
#: window apart, so what one context cannot show, that of the next position does.
LEFT = 50
RIGHT = LEAST + WINDOW
#: Suffixes of a group that are sorted together; of larger ones the windows are counted.
TOGETHER = 20_000
#: Words on one side by which a larger group is dealt: of ``LEAST`` words beyond the stem, one side has them.
SIDE = (LEAST - STEM) // 2


def word_codes(text: str) -> np.ndarray:
    """Hashes of a text's words, which are runs other than the six ASCII white-space characters."""
    words = text.encode("utf-8", "surrogatepass").split()
    return np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))


def kept_positions(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word positions whose stem has the smallest hash in some window, and those hashes."""
    n = len(codes) - STEM + 1
    if n < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    stem = np.full(n, STEM, np.uint64)
    for k in range(STEM):
        stem = (stem ^ codes[k : k + n]) * MIX
        stem ^= stem >> np.uint64(31)
    places = []
    for at in range(0, n - WINDOW + 1, 1 << 16):  # bounded memory for very long texts
        part = stem[at : at + (1 << 16) + WINDOW - 1]
        windows = np.lib.stride_tricks.sliding_window_view(part, WINDOW)
        places.append(np.unique(windows.argmin(axis=1) + np.arange(len(windows)) + at))
    kept = np.unique(np.concatenate(places))
    return kept, stem[kept]


def _context(codes: np.ndarray, at: int) -> tuple[bytes, bytes]:
    """The words before ``at``, nearest first, and those from it on; four big-endian bytes each."""
    short = codes.astype(np.uint32).astype(">u4")
    return short[max(0, at - LEFT) : at][::-1].tobytes(), short[at : at + RIGHT].tobytes()


def _common(a: bytes, b: bytes) -> int:
    """Leading words that two contexts share."""
    n = min(len(a), len(b)) // 4
    differ = np.frombuffer(a, np.uint32, n) != np.frombuffer(b, np.uint32, n)
    return int(differ.argmax()) if differ.any() else n


def _suffixes(source: DataFrame) -> DataFrame:
    """``id, h, at, stem``: the kept positions of every document."""
    schema = StructType([source.schema["id"], *columns(h="binary", at="long", stem="long").fields])

    def make():
        def apply(ids, hashes, texts):
            out = {"id": [], "h": [], "at": [], "stem": []}
            for i, h, text in zip(ids, hashes, texts):
                places, stems = kept_positions(word_codes(text))
                out["id"] += [i] * len(places)
                out["h"] += [h] * len(places)
                out["at"] += places.tolist()
                out["stem"] += stems.view(np.int64).tolist()
            return out

        return apply

    return map_rows(source, schema, make)


def _contexts(source: DataFrame) -> DataFrame:
    """``id, h, stem, members, at, before, after`` for the shared positions of every document."""
    fields = columns(h="binary", stem="long", members="long", at="long", before="binary", after="binary").fields
    schema = StructType([source.schema["id"], *fields])

    def make():
        def apply(ids, hashes, texts, shared):
            out = {f.name: [] for f in schema}
            for i, h, text, places in zip(ids, hashes, texts, shared):
                codes = word_codes(text)
                for p in places:
                    before, after = _context(codes, p["at"])
                    for name, value in zip(out, (i, h, p["stem"], p["members"], p["at"], before, after)):
                        out[name].append(value)
            return out

        return apply

    return map_rows(source, schema, make)


def _windows(rows: list[tuple], wanted: list[int]) -> dict[int, tuple[int, int, int]]:
    """What neighbours can miss: windows of ``LEAST`` words around a suffix that another document has.

    The longest match to the right need not be the longest in all. A window around a kept position
    starts at most ``WINDOW`` - 1 words before it, so equal windows are found by their words, one
    offset at a time. Windows of one suffix overlap; they are given as words to the left and right.
    """
    found: dict[int, tuple[int, int, int]] = {}
    for d in range(WINDOW):
        left, right = 4 * d, 4 * (LEAST - d)
        at = [k for k in wanted if len(rows[k][1]) >= left and len(rows[k][0]) >= right]
        if not at:
            continue
        seen: dict[bytes, list[int]] = {rows[k][1][:left] + rows[k][0][:right]: [] for k in at}
        for k, row in enumerate(rows):  # of each window the first suffix, and the first of another document
            first = seen.get(row[1][:left] + row[0][:right])
            if first is not None and len(row[1]) >= left and (
                not first or len(first) == 1 and row[2:4] != rows[first[0]][2:4]
            ):
                first.append(k)
        for k in at:
            both = seen[rows[k][1][:left] + rows[k][0][:right]]
            if len(both) == 2:
                partner = both[0] if rows[both[0]][2:4] != rows[k][2:4] else both[1]
                l, r, _ = found.get(k, (d, LEAST - d, partner))
                found[k] = max(l, d), max(r, LEAST - d), partner
    return found


def _neighbours(groups: DataFrame) -> DataFrame:
    """``id, h, start, stop, other_id``: what each suffix shares with its neighbours of other documents.

    Groups come sorted by the words after the position, so the longest match to the right is the
    nearest suffix of another document before or behind; matches are extended to both sides. In
    groups of more than two, equal windows are looked up as well.
    """
    schema = StructType([
        groups.schema["id"], *columns(h="binary", start="long", stop="long").fields,
    ]).add("other_id", groups.schema["id"].dataType)
    target = to_arrow_schema(schema)

    def run(batches):
        for group in _grouped(batches, 2):
            rows = [r[2:] for r in group]  # after, before, id, h, at
            out = []
            pairs = set()
            for order in (range(len(rows)), range(len(rows) - 1, -1, -1)):
                last = other = None  # the last suffix, and the last one of a document before its
                for k in order:
                    own = rows[k][2:4]
                    near = last if last is not None and rows[last][2:4] != own else other
                    if near is not None:
                        pairs.add((min(k, near), max(k, near)))
                    if last is not None and rows[last][2:4] != own:
                        other = last
                    last = k
            runs: dict[int, tuple[int, int, int]] = {}  # of each suffix: words to the left and right, partner
            for i, j in pairs:
                right, left = _common(rows[i][0], rows[j][0]), _common(rows[i][1], rows[j][1])
                if left + right >= LEAST:
                    for x, y in ((i, j), (j, i)):
                        l, r, _ = runs.get(x, (0, 0, y))
                        runs[x] = max(l, left), max(r, right), y
            # A run that reaches as far as windows do gains nothing from them.
            open_rows = [
                k for k, (after, before, *_) in enumerate(rows)
                if (run := runs.get(k, (-1, -1, k)))[0] < min(WINDOW - 1, len(before) // 4)
                or run[1] < min(LEAST, len(after) // 4)
            ]
            if len(rows) > 2 and open_rows:
                for k, (left, right, y) in _windows(rows, open_rows).items():
                    l, r, _ = runs.get(k, (0, 0, y))
                    runs[k] = max(l, left), max(r, right), y
            for k, (left, right, y) in runs.items():
                out.append((rows[k][2], rows[k][3], rows[k][4] - left, rows[k][4] + right, rows[y][2]))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(zip(*out), target)], schema=target
                )

    return groups.mapInArrow(run, schema)


def _equal_windows(crowded: DataFrame) -> DataFrame:
    """``id, h, start, stop, other_id``: what suffixes too many to sort together share, found by counting.

    Each window of ``LEAST`` words around a stem is a row; those of one document only are dropped as
    stems are. Windows with ``SIDE`` words or more before the stem come from the deal by the words
    before, the others from the deal by those behind.
    """

    def window(d: int):
        whole = (F.length("before") >= 4 * d) & (F.length("after") >= 4 * (LEAST - d))
        words = F.xxhash64(F.lit(d), F.substring("before", 1, 4 * d), F.substring("after", 1, 4 * (LEAST - d)))
        return F.when(whole, F.struct(F.lit(d).alias("d"), words.alias("words")))

    own = F.when(F.col("side") == 1, F.array(*map(window, range(SIDE, WINDOW)))).otherwise(
        F.array(*map(window, range(SIDE)))
    )
    windows = crowded.select("id", "h", "stem", "at", F.explode(own).alias("w")).where("w is not null").select(
        "id", "h", "stem", "at", "w.d", "w.words", F.xxhash64("id", "h").alias("document")
    )
    ends = F.struct("document", "id")
    shared, _ = write_table(
        windows.groupBy("stem", "words").agg(F.min(ends).alias("low"), F.max(ends).alias("high"))
        .where("low.document <> high.document"), "shared-windows",
    )
    start = F.col("at") - F.col("d")
    other = F.when(F.col("low.document") != F.col("document"), F.col("low.id")).otherwise(F.col("high.id"))
    return windows.join(shared, ["stem", "words"]).groupBy("id", "h", "at").agg(
        F.min(start).alias("start"), F.max(start + LEAST).alias("stop"), F.min(other).alias("other_id")
    ).drop("at")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per repeated passage: ``id_col, start_word, n_words, other_id``.

    A passage is a longest run of words, ``LEAST`` at least, covered by runs of that length that
    stand in another document too; ``other_id`` is one such document (the smallest of those met).
    Of every document the suffixes at minimiser positions are kept; those whose first ``STEM``
    words no other document has are dropped by counting. The rest are sorted within their stem and
    compared with their neighbours, to the right and to the left. A stem of more than ``TOGETHER``
    suffixes is dealt by the words before and by the words behind it, since a match has ``SIDE``
    words more on one of the two sides; of what is still as large then, being alike over
    ``STEM + SIDE`` words, all windows of ``LEAST`` words are counted.

    A null text is the empty text; texts of fewer than ``LEAST`` words have no passages. Repeated
    rows (same id and text) are one document; equal texts under different ids repeat as a whole.
    Ids may be null. No rows give no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("body")).select(
        "id", F.unhex(F.md5("body")).alias("h"), "body"
    )
    kept, _ = write_table(_suffixes(source), "suffixes")
    document = F.xxhash64("id", "h")
    shared = kept.groupBy("stem").agg(
        F.count(F.lit(1)).alias("members"), F.min(document).alias("low"), F.max(document).alias("high")
    ).where("low <> high").select("stem", "members")
    places = kept.join(shared, "stem").groupBy("id", "h").agg(
        F.collect_set(F.struct("at", "stem", "members")).alias("places")  # bounded by the document
    )
    p = places.select(F.col("id").alias("pid"), F.col("h").alias("ph"), "places")
    joined = source.join(p, (F.col("h") == F.col("ph")) & F.col("id").eqNullSafe(F.col("pid")))
    once = joined.select("id", "h", "body", "places")
    suffixes, _ = write_table(_contexts(once), "suffix-contexts")

    deal = suffixes.where(F.col("members") <= TOGETHER).withColumn("deal", F.lit(0).cast("long"))
    large = suffixes.where(F.col("members") > TOGETHER)
    crowded = None
    if not large.isEmpty():
        sides = F.explode(F.array(
            F.struct(F.lit(1).alias("side"), F.xxhash64(F.lit(1), F.substring("before", 1, 4 * SIDE)).alias("deal")),
            F.struct(F.lit(2).alias("side"), F.xxhash64(F.lit(2), F.substring("after", 4 * STEM + 1, 4 * SIDE)).alias("deal")),
        ))
        sided, _ = write_table(large.withColumn("s", sides).select(*large.columns, "s.side", "s.deal"), "suffix-sides")
        sizes = sided.groupBy("stem", "deal").agg(F.count(F.lit(1)).alias("size"))
        dealt = sided.join(sizes, ["stem", "deal"])
        crowded = dealt.where(F.col("size") > TOGETHER)
        deal = deal.unionByName(dealt.where(F.col("size") <= TOGETHER).select(deal.columns))
    groups = deal.select("stem", "deal", "after", "before", "id", "h", "at").repartition(
        task_count(spark), "stem", "deal"
    ).sortWithinPartitions("stem", "deal", "after", "before", "id", "h", "at")
    matches = _neighbours(groups)
    if crowded is not None:
        matches = matches.unionByName(_equal_windows(crowded))
    found, _ = write_table(matches, "suffix-matches")

    # Overlapping and touching runs of a document are one passage.
    own = Window.partitionBy("id", "h").orderBy("start", "stop", "other_id")
    reach = F.max("stop").over(own.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("start") <= F.col("reach"), 0).otherwise(1)
    runs = found.distinct().withColumn("reach", reach).withColumn("fresh", fresh)
    runs = runs.withColumn("passage", F.sum("fresh").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("id", "h", "passage").agg(
        F.min("start").alias("start_word"), F.max("stop").alias("stop"), F.min("other_id").alias("other_id")
    ).select(F.col("id").alias(id_col), "start_word", (F.col("stop") - F.col("start_word")).alias("n_words"), "other_id")
