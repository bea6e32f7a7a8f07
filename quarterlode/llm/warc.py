"""WARC archives: pages written as records, and records read back, segments and all.

A page becomes a ``response`` record whose block is an HTTP message in chunked transfer
framing. A page with the payload of an earlier one becomes a ``revisit`` record without
payload. Blocks above ``segment_bytes`` are cut: the first part stays in the response, the
others are ``continuation`` records that name the first record as their origin. Reading
groups the parts by origin, orders them by segment number, verifies that none is missing
and that they have the declared total length, and only then decodes the framing.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlode.session import materialise

LEAST_SHARED = 100  # bytes from which equal payloads are stored once
HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"

CHUNKED = re.compile(rb"^transfer-encoding:[ \t]*chunked[ \t]*\r?$", re.IGNORECASE | re.MULTILINE)


def record_id(page: Column, digest: Column) -> Column:
    """Name of a page's record; equal rows have equal names."""
    h = F.md5(F.concat_ws("|", F.coalesce(page.cast("string"), F.lit("-")), digest))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def chunked(payload: bytes, size: int) -> bytes:
    """Chunked transfer framing of a payload."""
    parts = [b"%x\r\n%s\r\n" % (len(payload[i : i + size]), payload[i : i + size]) for i in range(0, len(payload), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes | None:
    """Payload of a chunked body; ``None`` if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            return None
        try:
            size = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            return None
        at = end + 2
        if size == 0:
            return b"".join(out)
        if size < 0 or body[at + size : at + size + 2] != b"\r\n":
            return None
        out.append(body[at : at + size])
        at += size + 2


def _record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block


def _records(date: str, segment_bytes: int, chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                common = [("WARC-Date", date), ("WARC-Target-URI", quote(row["url"], safe=":/?#[]@!$&'()*+,;=%~") if row["url"] else None),
                          ("Page-ID", row["page"]), ("WARC-Payload-Digest", f"sha256:{row['digest']}")]
                named = [("WARC-Record-ID", row["record"])]
                if row["refers"]:
                    yield _one(_record([("WARC-Type", "revisit"), *named, *common, ("WARC-Refers-To", row["refers"])], b""))
                    continue
                block = HEAD + chunked((row["html"] or "").encode(), chunk_bytes)
                parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
                first = [("WARC-Type", "response"), *named, *common, ("Content-Type", "application/http;msgtype=response")]
                if len(parts) > 1:
                    first.append(("WARC-Segment-Number", "1"))
                yield _one(_record(first, parts[0]))
                for n, part in enumerate(parts[1:], 2):
                    fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{row['record'][:-1]}:{n}>"), ("WARC-Date", date),
                              ("WARC-Segment-Origin-ID", row["record"]), ("WARC-Segment-Number", str(n))]
                    if n == len(parts):
                        fields.append(("WARC-Segment-Total-Length", str(len(block))))
                    yield _one(_record(fields, part))

    def _one(record: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([record], pa.binary())], ["record"])

    return run


def write_archive(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    date: str = "2026-01-01T00:00:00Z", segment_bytes: int = 32768, chunk_bytes: int = 8192, records_per_file: int = 20_000,
) -> None:
    """Write a record for every row to gzip archives below ``path``.

    Null html is an empty payload, a null id or url is left out of its record. Of equal
    payloads of at least 100 bytes the row with the smallest id is the response (if all
    ids are null, all are); rows that repeat its id are responses, too. Other columns are
    not written.
    """
    html = F.coalesce(pages[html_col], F.lit(""))
    rows = pages.select(pages[id_col].alias("page"), pages[url_col].alias("url"), html.alias("html"), F.sha2(html, 256).alias("digest"))
    large = rows.where(F.octet_length("html") >= LEAST_SHARED)
    shared = large.groupBy("digest").agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = materialise(shared.select(F.col("digest").alias("shared"), "first"), "shared")
    found = rows.join(shared, rows.digest == shared.shared, "left")
    again = F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))
    named = found.select(
        F.col("page").cast("string").alias("page"), "url", F.when(~again, F.col("html")).alias("html"), "digest",
        record_id(F.col("page"), F.col("digest")).alias("record"), F.when(again, record_id(F.col("first"), F.col("digest"))).alias("refers"))
    records = named.mapInArrow(_records(date, segment_bytes, chunk_bytes), "record binary")
    # the text writer puts a record's bytes down as they are, and the end of record behind each
    (records.select(F.col("record").cast("string")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


def number(text: str | None) -> int | None:
    """A header's number; ``None`` if there is none or it is not made of digits."""
    return int(text) if text is not None and text.isascii() and text.isdigit() and len(text) < 19 else None


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes, bool]]:
    """Fields and block of each record of an archive, one at a time, and whether the record is sound.

    Not sound are a record without a proper ``Content-Length``, whose block is left out
    and whose end is the next record, and one that the archive's end cuts off. Behind
    broken compression nothing can be read: the archive ends there.
    """
    # no buffer around the inflating file: a buffer that meets broken data loses what it has read before
    stream = gzip.GzipFile(fileobj=io.BytesIO(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)
    fields: dict[str, str] = {}
    try:
        while line := stream.readline():
            if not line.startswith(b"WARC/"):
                continue
            while (line := stream.readline().strip(b"\r\n")):
                name, _, value = line.partition(b":")
                fields[name.decode("utf-8", "replace").strip().lower()] = value.strip().decode("utf-8", "replace")
            length = number(fields.get("content-length"))
            block = b"" if length is None else stream.read(length)
            whole, found, fields = len(block) == length, fields, {}
            yield found, block, whole
    except (EOFError, OSError, zlib.error):
        if fields:
            yield fields, b"", False


def payload_of(block: bytes) -> bytes | None:
    """Payload of an HTTP message, its chunked framing decoded; ``None`` if the head or the framing is broken."""
    head, end, body = block.partition(b"\r\n\r\n")
    if not end:
        return None
    return dechunked(body) if CHUNKED.search(head) else body


def finished(kind: str, block: bytes, declared: str | None, whole: bool) -> tuple:
    """Payload, its length, its digest, and whether the record is intact.

    A revisit keeps the digest that it declares and has no payload.
    """
    payload = payload_of(block) if kind == "response" and whole else None
    digest = declared if payload is None else hashlib.sha256(payload).hexdigest()
    if kind == "revisit":
        return None, None, declared, whole
    if payload is None or digest != declared:
        return None, None, None, False
    return payload, len(payload), digest, True


READ = "record string, page string, type string, refers string, payload binary, payload_bytes bigint, digest string, intact boolean"
READ_TYPES = [pa.string()] * 4 + [pa.binary(), pa.int64(), pa.string(), pa.bool_()]
PARTS = ("record string, page string, type string, declared string, refers string, segment int, total bigint, "
         "block binary, sound boolean")
PART_TYPES = [pa.string()] * 5 + [pa.int32(), pa.int64(), pa.binary(), pa.bool_()]
BAD_SEGMENT = -1  # a number that cannot be read: the record that it belongs to is not whole
HELD = 1 << 22  # bytes of blocks that are handed on at once


def _batch(rows: list[tuple], schema: str, kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [x.split()[0] for x in schema.split(", ")])


def _rows_of(segmented: bool, data: bytes) -> Iterator[tuple[int, tuple]]:
    """Bytes and row of each record of an archive: ``PARTS`` of segments, or ``READ`` of the others."""
    for f, block, sound in parse(data):
        kind = f.get("warc-type")
        # a continuation without a number is a part all the same
        if ("warc-segment-number" in f or kind == "continuation") != segmented or kind not in ("response", "revisit", "continuation"):
            continue
        declared, refers = f.get("warc-payload-digest", "").removeprefix("sha256:") or None, f.get("warc-refers-to")
        if segmented:
            at = number(f.get("warc-segment-number"))
            yield len(block), (
                f.get("warc-segment-origin-id", f.get("warc-record-id")), f.get("page-id"), kind, declared, refers,
                at if at is not None and at < 1 << 31 else BAD_SEGMENT, number(f.get("warc-segment-total-length")), block, sound)
        else:
            yield len(block), (f.get("warc-record-id"), f.get("page-id"), kind, refers, *finished(kind, block, declared, sound))


def _parsed(segmented: bool):
    schema, kinds = (PARTS, PART_TYPES) if segmented else (READ, READ_TYPES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):  # one archive in Python at a time
                rows, held = [], 0
                for size, row in _rows_of(segmented, data.as_py()):
                    rows.append(row)
                    held += size + 200
                    if held > HELD:
                        yield _batch(rows, schema, kinds)
                        rows, held = [], 0
                yield _batch(rows, schema, kinds)

    return run


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Decode the blocks put together from segments."""
    for batch in batches:
        yield _batch([(r["record"], r["page"], r["type"], r["refers"], *finished(r["type"], r["block"], r["declared"], r["whole"]))
                      for r in batch.to_pylist()], READ, READ_TYPES)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The pages of the archives below ``path``, gzip or plain: ``READ``.

    ``intact`` is false, and payload and digest of a response are null, if a segment is
    missing, a number in a header cannot be read, lengths or digest do not fit, the
    framing is broken, or the archive is cut off in the record; what stands behind broken
    compression is not found. Segments without their first one are one row of type
    ``continuation``. Segments of one record may lie in different archives. Records
    written twice are read twice. An archive is one row, so it has to be below 2 GB; it is
    inflated once for whole records, which are not shuffled, and once for segments, as
    this costs less than to store the inflated blocks.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    single = files.mapInArrow(_parsed(False), READ)
    return reassembled(files.mapInArrow(_parsed(True), PARTS)).mapInArrow(_finished, READ).unionByName(single)


def reassembled(parts: DataFrame) -> DataFrame:
    """Whole blocks from segments: grouped by origin, ordered by number, their total length verified."""
    opening = F.col("type") != "continuation"
    pieces = parts.groupBy("record", "segment").agg(
        F.first("page", True).alias("page"), F.max(F.when(opening, F.col("type"))).alias("type"), F.min("sound").alias("sound"),
        F.first("declared", True).alias("declared"), F.first("refers", True).alias("refers"), F.max("total").alias("total"),
        F.first("block").alias("block"), F.count(F.lit(1)).alias("copies"))
    # records written twice have each segment twice: one block for both, and as many rows as first segments
    groups = pieces.groupBy("record").agg(
        F.first("page", True).alias("page"), F.max("type").alias("type"), F.first("declared", True).alias("declared"),
        F.first("refers", True).alias("refers"), F.max("total").alias("total"),
        F.max(F.when(F.col("type").isNotNull(), F.col("copies"))).alias("copies"), F.min("sound").alias("sound"),
        F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("list"))
    block = F.expr("CAST(array_join(transform(list, x -> CAST(x.block AS STRING)), '') AS BINARY)")  # bytes stay as they are
    size = F.expr("aggregate(list, 0L, (a, x) -> a + octet_length(x.block))")
    whole = (F.col("list")[F.size("list") - 1]["segment"] == F.size("list")) & (size == F.col("total"))
    whole = whole & F.col("type").isNotNull() & F.col("sound")
    out = groups.select(
        "record", "page", F.coalesce("type", F.lit("continuation")).alias("type"), "declared", "refers", block.alias("block"), F.coalesce(whole, F.lit(False)).alias("whole"),
        F.explode(F.sequence(F.lit(1), F.coalesce("copies", F.lit(1)).cast("int"))).alias("copy"))
    return out.drop("copy")
