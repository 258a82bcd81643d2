"""Web archives: write captures as WARC records, read them back, assemble their transactions."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType

from lexmill.llm.common import columns
from lexmill.session import write_table

# Fixed values of the archive format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PRIMARY = ("response", "revisit", "resource")
EOL = "\r\n"
EOL_BYTES, SEPARATOR = b"\r\n", b"\r\n\r\n"
HEX32, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

RECORDS = columns(
    warc_type="string", record_id="string", concurrent_to="string", refers_to="string", target_uri="string",
    warc_date="string", payload_digest="string", http_length="long",
).add("fields", ArrayType(columns(name="string", value="string"))).add("payload", BinaryType())
#: Payload bytes handed over at a time when archives are read.
BATCH_BYTES = 4 << 20


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 sum: four groups of 40 bits."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.upper(F.concat(*parts)), HEX32, BASE32)


def _urn(kind: str) -> Column:
    """A record id from the capture's key; the key holds page, url, content and occurrence."""
    digest = F.md5(F.concat(F.lit(kind), F.col("capture_key")))
    cut = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(headers: list[tuple[str, Column | None]], block: Column) -> Column:
    """One record without its closing two line ends; headers with a null value are left out."""
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in headers]
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))
    return F.concat(F.concat_ws(EOL, F.lit(VERSION), *lines, length), F.lit(EOL * 2), block)


def with_revisits(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0
) -> DataFrame:
    """``page_id, url, html, digest, n_bytes, occurrence, first_id``: first_id is null for responses.

    Of pages with equal payloads of at least ``min_bytes`` bytes the one with the smallest id is
    the response and the others revisit it. Payloads are compared by SHA-256 and length; only
    groups of two and more are joined back, by page. A null page counts as empty, null ids come
    after all others, and of repeated rows the first occurrence is the response.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    base = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html")
    )
    keyed = base.select("page_id", F.unhex(F.sha2("html", 256)).alias("sha"), F.octet_length("html").alias("n"))
    groups = keyed.where(F.col("n") >= min_bytes).groupBy("sha").agg(
        F.count(F.lit(1)).alias("members"), F.min("page_id").alias("first_id")
    )
    page_key = F.concat(F.coalesce(F.col("page_id").cast("string"), F.lit("-")).cast("binary"), F.col("sha"))
    members = keyed.join(groups.where("members > 1"), "sha").select(
        page_key.alias("page_key"), F.lit(True).alias("member"), "first_id"
    ).distinct()
    place = Window.partitionBy("page_key").orderBy("url")
    rows = base.withColumn("sha", F.unhex(F.sha2("html", 256))).withColumn("page_key", page_key)
    joined = rows.withColumn("occurrence", F.row_number().over(place)).join(members, "page_key", "left")
    is_first = F.col("page_id").eqNullSafe(F.col("first_id")) & (F.col("occurrence") == 1)
    return joined.select(
        "page_id", "url", "html", base32_sha1(F.col("html")).alias("digest"),
        F.octet_length("html").alias("n_bytes"), "occurrence",
        (F.col("member").isNotNull() & ~is_first).alias("again"), "first_id",
        F.lower(F.hex("sha")).alias("sha"),
    )


def write_archive(captures: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", codec: str = "gzip") -> None:
    """Write captures of ``with_revisits`` as request, response or revisit, and metadata records.

    The writer is Spark's text writer with two line ends as separator, so attempts, commits and
    file systems are Spark's. A file holds one task's captures, compressed as a whole;
    ``codec="none"`` leaves it plain. Line ends in a url are percent-encoded; a page without url has no target.
    """
    text = lambda c: F.col(c).cast("string")
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    key = lambda page, n: F.concat_ws("|", F.coalesce(page.cast("string"), F.lit("-")), F.col("sha"), n)
    rows = captures.withColumn("capture_key", key(F.col("page_id"), text("occurrence")))
    rows = rows.withColumn("rid", _urn("response"))
    rows = rows.withColumn("own_key", F.col("capture_key")).withColumn(
        "capture_key", key(F.col("first_id"), F.lit("1"))
    ).withColumn("first_rid", F.when(F.col("again"), _urn("response"))).withColumn("capture_key", F.col("own_key"))
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "),
        text("n_bytes"), F.lit(EOL * 2),
    )
    common = [("WARC-Date", F.lit(date)), ("WARC-Target-URI", url)]
    http_type = lambda kind: ("Content-Type", F.lit(f"application/http; msgtype={kind}"))
    request = _record(
        [("WARC-Type", F.lit("request")), ("WARC-Record-ID", _urn("request")),
         ("WARC-Concurrent-To", F.col("rid")), *common, http_type("request")],
        F.concat(F.lit("GET "), F.coalesce(url, F.lit("/")), F.lit(f" HTTP/1.1{EOL * 2}")),
    )
    response = _record(
        [("WARC-Type", F.when(F.col("again"), "revisit").otherwise("response")),
         ("WARC-Record-ID", F.col("rid")), *common, ("WARC-Payload-Digest", digest),
         ("WARC-Refers-To", F.col("first_rid")),
         ("WARC-Profile", F.when(F.col("again"), PROFILE)), http_type("response")],
        F.concat(http, F.when(F.col("again"), F.lit("")).otherwise(F.col("html"))),
    )
    metadata = _record(
        [("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", _urn("metadata")),
         ("WARC-Concurrent-To", F.col("rid")), *common, ("Content-Type", F.lit("application/warc-fields"))],
        F.concat_ws(
            EOL,
            F.concat(F.lit("pageId: "), text("page_id")),
            F.when(F.col("again"), F.concat(F.lit("refersToPageId: "), text("first_id"))),
        ),
    )
    records = rows.select(F.explode(F.array(request, response, metadata)).alias("value"))
    records.write.option("lineSep", EOL * 2).option("compression", codec).text(path)


def field(name: str) -> Column:
    """A header of the HTTP message, or a field of a metadata record; null if it is missing."""
    return F.get(F.filter("fields", lambda f: f["name"] == name), F.lit(0))["value"]


def _fields(lines: list[bytes]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if colon:
            out[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    return out


def _record_at(data: bytes, at: int) -> tuple[tuple, int] | int:
    """The record that starts at a byte and where it ends; if it is not all there, how many bytes it takes."""
    end = data.find(EOL_BYTES * 2, at)
    if not data.startswith(b"WARC/", at):
        raise ValueError(f"no archive record at byte {at}")
    if end < 0:
        return len(data) + 1
    head = _fields(data[at:end].split(EOL_BYTES)[1:])
    start = end + 4
    stop = start + int(head["content-length"])
    if stop > len(data):
        return stop
    block, fields, length = data[start:stop], {}, None
    if head.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(EOL_BYTES * 2)
        fields = _fields(http.split(EOL_BYTES)[1:])
        length = int(fields["content-length"]) if fields.get("content-length", "").isdigit() else None
    elif head.get("content-type", "") == "application/warc-fields":
        fields, payload = _fields(block.split(EOL_BYTES)), b""
    else:
        payload = block
    digest = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
    return (
        head.get("warc-type"), head.get("warc-record-id"), head.get("warc-concurrent-to"),
        head.get("warc-refers-to"), head.get("warc-target-uri"), head.get("warc-date"), digest,
        length, [{"name": k, "value": v} for k, v in fields.items()], payload,
    ), stop


def parse_parts(parts: Iterable[bytes]) -> Iterator[tuple]:
    """The records of archives that come in parts, as rows of ``RECORDS``; holds a part and a record."""
    held: list[bytes] = []
    size, need = 0, 1
    for part in parts:
        held.append(part)
        size += len(part)
        if size < need:
            continue
        data, at = b"".join(held), 0
        while True:
            while data.startswith(EOL_BYTES, at):
                at += 2
            found = _record_at(data, at) if at < len(data) else at + 1
            if isinstance(found, int):
                break
            yield found[0]
            at = found[1]
        held, size, need = [data[at:]], len(data) - at, found - at
    if b"".join(held).strip():
        raise ValueError("the last record is cut off")


def parse_records(data: bytes) -> Iterator[tuple]:
    """The records of one archive; plain or gzip, whole or by record."""
    if data[:2] == b"\x1f\x8b":
        import gzip

        data = gzip.decompress(data)
    return parse_parts([data])


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives in a folder, one row each.

    A file is read by one task. Compressed files (``.gz``) are streamed by Spark's text source, which
    never splits them, as pieces between two line ends, so they may have any size; a task holds a
    batch of pieces and a record. Other files are read whole and have 2 GB at most. A damaged record
    fails the read. An empty folder gives no rows.
    """
    names = [f.name for f in RECORDS]
    target = to_arrow_schema(RECORDS)

    def rows_of(records):
        rows, held = [], 0
        for record in records:
            rows.append(dict(zip(names, record)))
            held += len(record[-1]) + 500
            if held > BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(rows, schema=target)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=target)

    def streamed(batches):
        yield from rows_of(parse_parts(SEPARATOR.join([*b.column(0).to_pylist(), b""]) for b in batches))

    def whole(batches):
        for batch in batches:
            for data in batch.column(0).to_pylist():
                yield from rows_of(parse_records(data))

    text = spark.read.option("lineSep", EOL * 2).option("pathGlobFilter", "*.gz").text(path)
    plain = spark.read.format("binaryFile").load(path).where(~F.col("path").endswith(".gz"))
    return text.select(F.col("value").cast("binary").alias("value")).mapInArrow(streamed, RECORDS).unionByName(
        plain.select("content").mapInArrow(whole, RECORDS))


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: ``capture_id, response, request, metadata``, the last an array.

    A capture is a response, revisit or resource record; request and metadata records join it
    through concurrent-to ids, which may point to the capture, from the capture to them, or to a
    record that itself belongs to the capture. Ids are joined first, on narrow rows; then each
    capture's few records are grouped. Records that lead to no capture give no row; a capture
    without request or metadata has null and an empty array; of several requests the first by id
    stays. All columns of ``records`` but concurrent_to go into the nested rows. ``records`` is
    scanned several times, so pass a stored table. No rows give no rows.
    """
    main = F.col("warc_type").isin(*PRIMARY)
    body = F.struct("record_id", *[c for c in records.columns if c not in ("record_id", "concurrent_to")])
    rows = records.select("warc_type", "record_id", "concurrent_to", body.alias("body"))
    captures = rows.where(main)
    own = captures.select(F.col("record_id").alias("part"), F.col("record_id").alias("capture_id")).distinct()
    direct, _ = write_table(
        rows.where(~main).join(own, F.col("concurrent_to") == F.col("part"), "left").drop("part"), "archive-links"
    )
    linked = captures.select(F.col("record_id").alias("capture_id"), "warc_type", "body").unionByName(
        direct.where("capture_id is not null").select("capture_id", "warc_type", "body")
    )
    rest = direct.where("capture_id is null").drop("capture_id")
    if not rest.isEmpty():
        # The capture names the record, or the record names one whose capture is known by now.
        named = captures.where("concurrent_to is not null").select(
            F.col("concurrent_to").alias("part"), F.col("record_id").alias("capture_id"))
        known = direct.where("capture_id is not null").select(F.col("record_id").alias("part"), "capture_id")
        known = named.unionByName(known).groupBy("part").agg(F.min("capture_id").alias("capture_id"))
        by_id = rest.join(known, F.col("record_id") == F.col("part"), "left").drop("part")
        found = by_id.where("capture_id is not null")
        hop = by_id.where("capture_id is null").drop("capture_id").join(
            known, F.col("concurrent_to") == F.col("part")).drop("part")
        linked = linked.unionByName(found.unionByName(hop).select("capture_id", "warc_type", "body"))
    pick = lambda kinds: F.sort_array(
        F.collect_list(F.when(F.col("warc_type").isin(*kinds), F.col("body"))))
    grouped = linked.groupBy("capture_id").agg(
        pick(PRIMARY).alias("main"), pick(["request"]).alias("requests"), pick(["metadata"]).alias("metadata")
    )
    return grouped.where(F.size("main") > 0).select(
        "capture_id",
        F.get("main", F.lit(0)).alias("response"),
        F.get("requests", F.lit(0)).alias("request"),
        "metadata",
    )
