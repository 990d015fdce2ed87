"""WARC archives: pages are written as records and read back, long ones in segments.

A page's block is an HTTP message whose body is framed in chunks. Blocks over ``SEGMENT_BYTES`` are cut: the
record itself is segment 1, and continuation records name it as their origin, number themselves, and the last one gives the
total length. Of pages with equal payloads one is stored whole and the others are revisit records without a body.

Reading regroups continuation records by their origin, orders them by segment number, verifies the total length, decodes
the chunks and verifies the payload's digest. What does not verify is a row with its fault, never a missing row.

Archives are gzip files, one per task, through Spark's own text sink and source, so any file system that Spark
reaches will do. The source only carries the bytes; records are told apart by their declared lengths, whatever they hold.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm.common import broadcast_if_small, staged, text_or_empty
from claimloom.sources.scratch import scratch_path

SEGMENT_BYTES = 4096
CHUNK_BYTES = 1024
#: Payloads of fewer bytes are stored again rather than revisited.
REVISIT_BYTES = 1000
DATE = "2025-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BETWEEN = b"\r\n\r\nWARC/"
_BATCH_BYTES = 4_000_000
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")

#: Faults of a record; null where everything verifies.
SEGMENTS, LENGTH, FRAMING, DIGEST, TARGET = (
    "a segment is missing", "the total length differs", "the chunks are broken", "the digest differs", "no such record"
)


def record_name(record_id: str | None, digest: str, place: str = "") -> str:
    """The record's URI: the id (``!`` for a null one), the payload's digest, and where it was written if that is needed."""
    return f"<urn:record:{'!' if record_id is None else quote(record_id, safe='')}:{digest}{place}>"


def name_parts(name: str) -> tuple[str | None, str]:
    """The id and the digest of a record's URI; another archive's URI is an id as it stands."""
    parts = name.strip("<>").split(":")
    if parts[:2] != ["urn", "record"] or len(parts) < 4:
        return name, ""
    return None if parts[2] == "!" else unquote(parts[2]), parts[3]


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The payload in chunked transfer framing."""
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes | None:
    """The payload of a body in chunked framing (extensions and trailers are passed over); none if it is broken."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]{1,15}", size):
            return None
        at, length = end + 2, int(size, 16)
        if length == 0:
            return b"".join(parts) if body[at:] == b"\r\n" or body.endswith(b"\r\n\r\n") else None
        if body[at + length : at + length + 2] != b"\r\n":
            return None
        parts.append(body[at : at + length])
        at += length + 2


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A record without the empty lines that end it."""
    head = [b"WARC/1.1", *(f"{k}: {v}".encode() for k, v in fields), f"Content-Length: {len(block)}".encode()]
    return b"\r\n".join(head) + b"\r\n\r\n" + block


def page_records(
    record_id: str | None,
    url: str | None,
    payload: bytes,
    digest: str,
    *,
    revisit_of: tuple[str | None] | None = None,
    place: str = "",
    segment_bytes: int = SEGMENT_BYTES,
) -> Iterator[bytes]:
    """The records of one page: a revisit of another page's, or a response and its continuations."""
    name = record_name(record_id, digest, place)
    where = [("WARC-Target-URI", _UNSAFE.sub(lambda m: quote(m[0]), url))] if url else []
    base32 = base64.b32encode(bytes.fromhex(digest)).decode()
    fields = [
        ("WARC-Type", "response" if revisit_of is None else "revisit"),
        ("WARC-Record-ID", name),
        ("WARC-Date", DATE),
        *where,
        ("WARC-Payload-Digest", f"sha1:{base32}"),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if revisit_of is not None:
        refers = [("WARC-Refers-To", record_name(revisit_of[0], digest)), ("WARC-Profile", PROFILE)]
        yield record([*fields, *refers], _HTTP)
        return
    block = _HTTP + chunked(payload)
    if len(block) <= segment_bytes:
        yield record(fields, block)
        return
    cuts = range(0, len(block), segment_bytes)
    for number, at in enumerate(cuts, 1):
        part, numbered = block[at : at + segment_bytes], ("WARC-Segment-Number", str(number))
        if number == 1:
            yield record([*fields, numbered], part)
            continue
        own = [
            ("WARC-Type", "continuation"),
            ("WARC-Record-ID", f"{name[:-1]}:segment-{number}>"),
            ("WARC-Date", DATE),
            *where,
            ("WARC-Segment-Origin-ID", name),
            numbered,
        ]
        total = [("WARC-Segment-Total-Length", str(len(block)))] if number == len(cuts) else []
        yield record([*own, *total], part)


def planned(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    """``name``, ``url``, ``payload``, ``digest``, and for payloads that repeat ``part`` and the response's ``target``.

    Only digests and ids are shuffled, added up in the tasks that read them; the list of repeated digests is
    broadcast behind a count.
    """
    source = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(page_id).cast("string").alias("name"),
        F.col(url).cast("string").alias("url"),
        F.encode(text_or_empty(html), "UTF-8").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    long = source.where(F.octet_length("payload") >= REVISIT_BYTES).select("digest", "page_id", "name")
    each = long.groupBy("digest", "page_id", "name").agg(F.count(F.lit(1)).alias("rows"))
    last = F.max(F.struct("page_id", "name", "rows")).alias("last")
    repeated = each.groupBy("digest").agg(last, F.sum("rows").alias("rows")).where("rows > 1")
    repeated = staged(
        repeated.select(
            "digest",
            F.col("last.page_id").alias("last_id"),
            F.col("last.name").alias("target"),
            (F.col("last.rows") > 1).alias("tied"),
        ),
        "warc-repeated",
    )
    here = F.col("page_id").eqNullSafe(F.col("last_id"))
    part = (
        F.when(F.octet_length("payload") < REVISIT_BYTES, "short")
        .when(F.col("tied").isNull(), "alone")
        .when(~here, "again")
        .when(F.col("tied"), "tied")
        .otherwise("first")
    )
    joined = source.join(broadcast_if_small(repeated), "digest", "left")
    return joined.select("name", "url", "payload", "digest", "target", part.alias("part"))


def write(
    pages: DataFrame,
    path: str,
    *,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    segment_bytes: int = SEGMENT_BYTES,
) -> None:
    """Write a record per row of ``pages`` into gzip archives in the folder ``path``.

    The payload is the html in UTF-8, null as empty. Of rows with equal payloads of at least ``REVISIT_BYTES`` the one
    with the largest id is the response and the others revisit it; shorter ones are all responses. Rows that repeat
    that largest id are all responses. Null ids are smaller than any other. Other columns are not read. An empty
    table gives archives without page records.
    """

    def recorded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, row = TaskContext.get().partitionId(), 0
        info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:archive:{task}>"), ("WARC-Date", DATE)]
        rows, size = [record(info, b"")], 0
        for batch in batches:
            columns = [batch.column(i) for i in range(batch.num_columns)]
            for i in range(batch.num_rows):
                name, where, payload, digest, target, part = (c[i].as_py() for c in columns)
                row += 1
                # The target of a revisit is found by id and digest; rows that may share both also tell their place.
                place = "" if part in ("alone", "first") else f":{task}-{row}"
                revisit_of = (target,) if part == "again" else None
                for x in page_records(
                    name, where, payload, digest, revisit_of=revisit_of, place=place, segment_bytes=segment_bytes
                ):
                    rows.append(x)
                    size += len(x)
                    if size >= _BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["record"])
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["record"])

    records = planned(pages, page_id, url, html).mapInArrow(recorded, "record binary")
    text = records.select(F.col("record").cast("string"))
    text.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


class Archive:
    """The records of one archive, from its bytes in order; each record as long as it declares."""

    def __init__(self) -> None:
        self.bytes = bytearray()
        self.head: dict[str, str] | None = None
        self.length = 0

    def add(self, piece: bytes) -> Iterator[tuple[dict[str, str], bytes | None]]:
        """Fields and block of every record that ``piece`` completes; a header that cannot be read has no block."""
        self.bytes += piece
        while True:
            if self.head is None:
                blank = len(self.bytes) - len(self.bytes.lstrip(b"\r\n"))
                end = self.bytes.find(b"\r\n\r\n", blank)
                if end < 0:
                    return
                lines = bytes(self.bytes[blank:end]).decode("utf-8", "replace").split("\r\n")
                del self.bytes[: end + 4]
                self.head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
                size = self.head.get("content-length", "")
                if not lines[0].startswith("WARC/") or not re.fullmatch("[0-9]{1,15}", size):
                    # Go on at the next record's start.
                    yield self.head, None
                    self.head = None
                    start = self.bytes.find(_BETWEEN)
                    del self.bytes[: start if start >= 0 else len(self.bytes)]
                    continue
                self.length = int(size)
            if len(self.bytes) < self.length:
                return
            block = bytes(self.bytes[: self.length])
            del self.bytes[: self.length]
            yield self.head, block
            self.head = None

    def end(self) -> Iterator[tuple[dict[str, str], bytes | None]]:
        """What the end of the archive cuts off."""
        if self.head is not None:
            yield self.head, None
        self.__init__()


_RECORD = (
    "type string, name string, origin string, number int, total long, url string, digest string, refers_to string, block binary"
)


def _hex(digest: str) -> str | None:
    """The hexadecimal form of a declared SHA-1, which may be in base 32."""
    kind, _, value = digest.partition(":")
    if kind.lower() != "sha1":
        return None
    try:
        return base64.b32decode(value.upper()).hex() if len(value) == 32 else bytes.fromhex(value).hex()
    except ValueError:
        return None


def _number(value: str | None) -> int | None:
    return int(value) if value and re.fullmatch("[0-9]{1,15}", value) else None


def parsed(spark: SparkSession, path: str, *, segmented: bool) -> DataFrame:
    """The page records of all archives in ``path``: those cut in segments, or the others."""
    lines = spark.read.option("lineSep", _BETWEEN.decode()).text(path)
    pieces = lines.select(F.col("value").cast("binary").alias("piece"), F.col("_metadata.file_path").alias("file"))
    names = [x.split()[0] for x in _RECORD.split(", ")]
    types = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), *[pa.string()] * 3, pa.binary()]

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, file = Archive(), None
        out: list[tuple] = []
        size = 0
        for batch in batches:
            pieces, files = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                found: list[tuple[dict[str, str], bytes | None]] = []
                if files[i].as_py() != file:
                    found += archive.end()
                    file, start = files[i].as_py(), b""
                else:
                    start = _BETWEEN
                found += archive.add(start + pieces[i].as_py())
                for head, block in found:
                    kind, number = head.get("warc-type", "broken"), _number(head.get("warc-segment-number"))
                    if kind not in ("response", "resource", "revisit", "continuation", "broken"):
                        continue
                    if (number is not None) != segmented:
                        continue
                    name = head.get("warc-record-id", "")
                    origin = head.get("warc-segment-origin-id") or name
                    total = _number(head.get("warc-segment-total-length"))
                    told = _hex(head.get("warc-payload-digest", ""))
                    out.append(
                        (kind, name, origin, number, total, head.get("warc-target-uri"), told, head.get("warc-refers-to"), block)
                    )
                    size += len(block or b"")
                if size >= _BATCH_BYTES:
                    yield to_batch(out)
                    out, size = [], 0
        for head, _ in archive.end():
            number = _number(head.get("warc-segment-number"))
            if (number is not None) == segmented:
                name = head.get("warc-record-id", "")
                origin = head.get("warc-segment-origin-id") or name
                out.append((head.get("warc-type", "broken"), name, origin, number, None, None, None, None, None))
        yield to_batch(out)

    def to_batch(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) if out else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return pieces.mapInArrow(rows, _RECORD)


def reassembled(segments: list[dict]) -> tuple[bytes | None, str | None]:
    """The block of a record's segments in order of their numbers, or what is wrong with them.

    A segment that is there twice counts once.
    """
    parts: dict[int, bytes | None] = {}
    for segment in segments:
        if parts.get(segment["number"]) is None:
            parts[segment["number"]] = segment["block"]
    totals = {s["total"] for s in segments if s["total"] is not None}
    if sorted(parts) != list(range(1, len(parts) + 1)) or len(totals) != 1 or None in parts.values():
        return None, SEGMENTS
    block = b"".join(parts[k] for k in sorted(parts))
    return (block, None) if totals == {len(block)} else (None, LENGTH)


def payload_of(block: bytes) -> bytes | None:
    """The body of an HTTP message, decoded where it is chunked; none if its framing is broken."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"HTTP/"):
        return None
    coded = re.search(rb"(?im)^transfer-encoding:[ \t]*chunked[ \t]*\r?$", head)
    return unchunked(body) if coded else body


_PAGE = "record_type string, name string, url string, payload binary, payload_bytes long, digest string, refers_to string, fault string"


def _pages(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A page per group of segments (a list of one for a record that is whole)."""
    names = [x.split()[0] for x in _PAGE.split(", ")]
    types = [*[pa.string()] * 3, pa.binary(), pa.int64(), *[pa.string()] * 3]
    for batch in batches:
        out, size = [], 0
        for i in range(batch.num_rows):
            origin, segments = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            first = next((s for s in segments if s["type"] != "continuation"), segments[0])
            kind = first["type"]
            if segments[0]["number"] is None:
                block, fault = first["block"], None if first["block"] is not None else LENGTH
            else:
                block, fault = reassembled(segments)
            payload, digest = None, first["digest"]
            if kind == "revisit":
                pass
            elif block is not None:
                payload = block if kind == "resource" else payload_of(block)
                if payload is None:
                    fault = FRAMING
                else:
                    digest = hashlib.sha1(payload).hexdigest()
                    fault = DIGEST if first["digest"] not in (None, digest) else None
            bytes_ = None if payload is None else len(payload)
            out.append((kind, origin, first["url"], payload, bytes_, digest, first["refers_to"], fault))
            size += bytes_ or 0
            if size >= _BATCH_BYTES or i == batch.num_rows - 1:
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
                out, size = [], 0


def read(spark: SparkSession, path: str) -> DataFrame:
    """A row per page record of the archives in ``path``.

    ``record_type``, ``record_id`` (a string), ``url``, ``payload`` (null for revisits), ``payload_bytes``,
    ``payload_digest`` (of the payload as read; of a revisit, as declared), ``refers_to`` (an id) and ``fault``, null where
    all verifies. Continuations of one origin are grouped, at most a page's own bytes; other records are not shuffled. An
    archive that ends inside a record, a segment that is missing and a header that cannot be read are rows with a
    fault. Archives without page records give no rows.
    """
    fields = ("type", "number", "total", "url", "digest", "refers_to", "block")
    segment = F.struct(*fields)
    whole = parsed(spark, path, segmented=False).select("origin", F.array(segment).alias("segments"))
    cut = parsed(spark, path, segmented=True).groupBy("origin").agg(F.collect_list(segment).alias("segments"))
    pages = whole.mapInArrow(_pages, _PAGE).unionByName(cut.mapInArrow(_pages, _PAGE))

    def ids(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = [name_parts(x or "")[0] for x in batch.column("name").to_pylist()]
            refers = [x if x is None else name_parts(x)[0] for x in batch.column("refers_to").to_pylist()]
            columns = {c: batch.column(c) for c in ("record_type", "url", "payload", "payload_bytes")}
            columns |= {"record_id": pa.array(named, pa.string()), "refers_to": pa.array(refers, pa.string())}
            columns |= {"payload_digest": batch.column("digest"), "fault": batch.column("fault")}
            yield pa.RecordBatch.from_arrays([columns[c] for c in order], names=order)

    order = ["record_type", "record_id", "url", "payload", "payload_bytes", "payload_digest", "refers_to", "fault"]
    kinds = {"payload": "binary", "payload_bytes": "long"}
    return pages.mapInArrow(ids, ", ".join(f"{c} {kinds.get(c, 'string')}" for c in order))


def resolved(rows: DataFrame) -> DataFrame:
    """Rows of ``read`` in which revisits have the ``payload_bytes`` of the response that they name.

    A revisit whose response is absent, or has another digest or a fault, gets a fault of its own. Only short columns
    are shuffled; many revisits of one response are split adaptively or meet a broadcast behind a count.
    """
    rows = staged(rows.drop("payload"), "warc-read")
    revisits = rows.where("record_type = 'revisit'")
    named = revisits.select(F.col("refers_to").alias("record_id"), "payload_digest").distinct()
    whole = rows.where("record_type <> 'revisit' and fault is null")
    found = whole.join(broadcast_if_small(staged(named, "warc-named")), ["payload_digest"], "left_semi")
    found = found.groupBy("payload_digest", "record_id").agg(F.max("payload_bytes").alias("found_bytes"))
    found = staged(found.withColumnRenamed("payload_digest", "found_digest").withColumnRenamed("record_id", "found_id"), "warc-found")
    match = revisits["payload_digest"].eqNullSafe(found["found_digest"]) & revisits["refers_to"].eqNullSafe(found["found_id"])
    joined = revisits.join(broadcast_if_small(found), match, "left")
    fault = F.coalesce("fault", F.when(F.col("found_bytes").isNull(), TARGET))
    joined = joined.withColumn("payload_bytes", F.col("found_bytes")).withColumn("fault", fault)
    return rows.where("record_type <> 'revisit'").unionByName(joined.select(*rows.columns))


def round_trip(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """The pages written to archives in the shared folder and read back: rows of ``resolved``."""
    path = scratch_path(pages.sparkSession, "warc")
    write(pages, path, page_id=page_id, url=url, html=html)
    return resolved(read(pages.sparkSession, path))
