"""WARC archives: writing with segmented, chunked and revisit records; reading with reassembly.

Writing: every page is a record. Of pages with equal payloads of at least min_revisit bytes that with the smallest id is
a response, the others are revisits that name it. A response's block is an HTTP message in chunked transfer framing; a
block longer than segment_bytes is cut into a first record and continuation records, the last of which states the total
length. Records are rows whose last line break is the writer's line separator, in gzip files by Spark's committer.

Reading: the line separator is the version line, so a task streams its file record by record. A payload that holds the
version line is put together again by Content-Length. Continuation records are grouped by origin identifier, ordered by
segment number, checked for gaps and against the total length; then the HTTP message's chunked framing is decoded.

Edge cases: null payloads are empty; null urls are empty; null ids are written as such, and count as the largest;
repeated rows with one id and payload all stay responses with records of their own; a record with a missing segment, a
wrong total or broken framing has complete = false and a null payload; other columns, whatever their names, are not
read; an empty table gives no records.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import broadcast_if, materialize, small_batches, work_path

VERSION = b"WARC/1.1\r\n"
#: Fixed values of the format.
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = b"2024-01-01T00:00:00Z"
HTTP_TYPE = b"application/http;msgtype=response"
RECORD = "record_id string, type string, origin_id string, segment int, total long, refers_to string, digest string, block binary"
_ID = re.compile(r"<urn:millrace:page:(-?\d*):")


def header(kind: bytes, record_id: bytes, length: int, *more: tuple[bytes, bytes]) -> bytes:
    """The version line and the named fields of a record."""
    fields = [(b"WARC-Type", kind), (b"WARC-Record-ID", record_id), (b"WARC-Date", DATE), *more, (b"Content-Length", b"%d" % length)]
    return VERSION + b"".join(k + b": " + v + b"\r\n" for k, v in fields) + b"\r\n"


def chunked(body: bytes, size: int) -> bytes:
    """Chunked transfer framing."""
    parts = [b"%x\r\n%b\r\n" % (len(x), x) for x in (body[i : i + size] for i in range(0, len(body), size))]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(data: bytes) -> bytes | None:
    """The body behind chunked transfer framing; None where the framing is broken."""
    out, at = [], 0
    while True:
        end = data.find(b"\r\n", at)
        if end < 0:
            return None
        try:
            size = int(data[at:end].split(b";")[0], 16)
        except ValueError:
            return None
        if size == 0:  # trailer fields, if any, and an empty line
            rest = data[end:]
            return b"".join(out) if rest == b"\r\n\r\n" or (rest.endswith(b"\r\n\r\n") and not rest.startswith(b"\r\n\r\n")) else None
        at = end + 2 + size
        if size < 0 or data[at : at + 2] != b"\r\n":
            return None
        out.append(data[end + 2 : at])
        at += 2


def page_records(record_id: bytes, url: bytes, body: bytes, digest: bytes, refers_to: bytes | None, segment_bytes: int, chunk_bytes: int) -> list[bytes]:
    """The records of a page, each without its last line break."""
    about = ((b"WARC-Target-URI", url), (b"WARC-Payload-Digest", b"sha256:" + digest), (b"Content-Type", HTTP_TYPE))
    if refers_to is not None:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(body)
        return [header(b"revisit", record_id, len(block), *about, (b"WARC-Profile", PROFILE), (b"WARC-Refers-To", refers_to)) + block + b"\r\n"]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(body, chunk_bytes)
    if len(block) <= segment_bytes:
        return [header(b"response", record_id, len(block), *about) + block + b"\r\n"]
    out = []
    for n, at in enumerate(range(0, len(block), segment_bytes), 1):
        part = block[at : at + segment_bytes]
        number = (b"WARC-Segment-Number", b"%d" % n)
        if n == 1:
            out.append(header(b"response", record_id, len(part), *about, number) + part + b"\r\n")
            continue
        more = [number, (b"WARC-Segment-Origin-ID", record_id)]
        if at + segment_bytes >= len(block):
            more.append((b"WARC-Segment-Total-Length", b"%d" % len(block)))
        out.append(header(b"continuation", record_id[:-1] + b":%d>" % n, len(part), *more) + part + b"\r\n")
    return out


def write_warc(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", min_revisit: int = 100, segment_bytes: int = 16_384, chunk_bytes: int = 4_096) -> None:
    """Write a record per page to gzip archives below path."""
    body = F.coalesce(F.col(body_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), body.alias("body"), F.sha2(body, 256).alias("digest"))
    keys = materialize(rows.select("id", "digest", F.octet_length("body").alias("n")), "warc-digests")
    copies = keys.filter(F.col("n") >= min_revisit).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    # repeated ids: their records need identifiers of their own
    again = keys.groupBy("id", "digest").agg(F.count(F.lit(1)).alias("times"))
    plan = again.join(copies, "digest", "left").select("id", "digest", (F.col("times") > 1).alias("repeated"), F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first")).alias("first"))
    plan = materialize(plan.filter("repeated or first is not null"), "warc-revisits").select(F.col("id").alias("p_id"), F.col("digest").alias("p_digest"), "repeated", "first")
    plan = broadcast_if(plan, plan.count(), 500_000)
    dealt = rows.join(plan, F.col("id").eqNullSafe(F.col("p_id")) & (F.col("digest") == F.col("p_digest")), "left")
    dealt = dealt.select("id", "url", "body", "digest", "first", F.when(F.coalesce("repeated", F.lit(False)), F.monotonically_increasing_id()).alias("row"))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = lambda i, digest, row: f"<urn:millrace:page:{'' if i is None else i}:{digest[:16]}{'' if row is None else f':r{row}'}>".encode()
        for batch in batches:
            out = []
            for i, url, body, digest, first, row in zip(*(c.to_pylist() for c in batch.columns)):
                refers = None if first is None else name(first, digest, None)
                out += page_records(name(i, digest, row), " ".join(url.split()).encode(), body, digest.encode(), refers, segment_bytes, chunk_bytes)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    written = dealt.mapInArrow(records, "record binary").select(F.col("record").cast("string").alias("value"))
    with small_batches(pages.sparkSession):
        written.write.option("lineSep", "\r\n").option("compression", "gzip").text(path)


class Record:
    """A record that is read piece by piece: its named fields, its block, and how much of the block is still missing."""

    def __init__(self, data: bytes) -> None:
        self.head, self.parts = data, []
        self.fields: dict[bytes, bytes] | None = None
        self.missing = 1
        self._open(b"")

    def _open(self, more: bytes) -> None:
        self.head += more
        head, end, rest = self.head.partition(b"\r\n\r\n")
        if end:
            self.fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n"))}
            self.length = int(self.fields.get(b"content-length", b"0") or b"0")
            self.parts, self.missing = [rest], self.length - len(rest)

    def add(self, piece: bytes) -> None:
        """More of the record: a piece behind a version line that belongs to its block."""
        if self.fields is None:
            self._open(VERSION + piece)
        else:
            self.parts += [VERSION, piece]
            self.missing -= len(VERSION) + len(piece)

    @property
    def whole(self) -> bool:
        return self.fields is not None and self.missing <= 0

    def block(self) -> bytes:
        return b"".join(self.parts)[: self.length]


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of archives, one row each; gzip or plain files."""
    lines = spark.read.option("lineSep", VERSION.decode()).text(path).select(F.col("value").cast("binary").alias("piece"), F.col("_metadata.file_path").alias("file"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RECORD.split(", ")]
        types = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.binary()]
        held: Record | None = None
        at_file = None

        def row(fields: dict[bytes, bytes], block: bytes | None) -> tuple:
            text = lambda k: fields[k].decode() if k in fields else None
            number = lambda k: int(fields[k]) if k in fields else None
            return text(b"warc-record-id"), text(b"warc-type"), text(b"warc-segment-origin-id"), number(b"warc-segment-number"), number(b"warc-segment-total-length"), text(b"warc-refers-to"), (text(b"warc-payload-digest") or "").removeprefix("sha256:"), block

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(names), types)], names=names)

        for batch in batches:
            rows = []
            for piece, file in zip(*(c.to_pylist() for c in batch.columns)):
                if file != at_file:
                    if held is not None:  # the file before ended inside a block
                        rows.append(row(held.fields or {}, None))
                    held, at_file = None, file
                if held is None and not piece.strip():
                    continue
                if held is None:
                    held = Record(piece)
                else:
                    held.add(piece)
                if held.whole:
                    rows.append(row(held.fields, held.block()))
                    held = None
            yield batch_of(rows)
        if held is not None:
            yield batch_of([row(held.fields or {}, None)])

    return lines.mapInArrow(parse, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """Whole records: record_id, type, refers_to, complete, payload (null for revisits), payload_bytes, payload_digest.

    A response's length and digest are of the decoded payload, and must agree with the digest that the record states, if
    it states one. A revisit's are those that its record states; resolved() holds them against the response.
    """
    segment = F.struct(F.coalesce("segment", F.lit(1)).alias("segment"), "block")
    plain = records.filter("segment is null and type in ('response', 'revisit')").select("record_id", "type", "refers_to", "digest", F.lit(None).cast("long").alias("total"), F.array(segment).alias("parts"))
    first = F.col("segment") == 1
    grouped = (
        records.filter("segment is not null")
        .groupBy(F.coalesce("origin_id", "record_id").alias("record_id"))
        .agg(F.max(F.when(first, F.col("type"))).alias("type"), F.max(F.when(first, F.col("refers_to"))).alias("refers_to"), F.max(F.when(first, F.col("digest"))).alias("digest"), F.max("total").alias("total"), F.collect_list(segment).alias("parts"))
        .select("record_id", "type", "refers_to", "digest", F.coalesce("total", F.lit(-1)).alias("total"), "parts")
    )
    schema = "record_id string, type string, refers_to string, complete boolean, payload binary, payload_bytes long, payload_digest string"

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.string(), pa.string(), pa.bool_(), pa.binary(), pa.int64(), pa.string()]
        for batch in batches:
            out = []
            for record_id, kind, refers_to, stated, total, parts in zip(*(c.to_pylist() for c in batch.columns)):
                by_number = {p["segment"]: p["block"] for p in parts}
                whole = sorted(by_number) == list(range(1, len(by_number) + 1)) and None not in by_number.values() and kind is not None
                block = b"".join(by_number[k] for k in sorted(by_number)) if whole else b""
                whole = whole and (total is None or total == len(block))
                head, _, body = block.partition(b"\r\n\r\n")
                named = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
                if whole and kind != "revisit" and named.get(b"transfer-encoding", b"").lower() == b"chunked":
                    body = dechunked(body)
                if kind == "revisit":
                    size = int(named[b"content-length"]) if b"content-length" in named else None
                    out.append((record_id, kind, refers_to, whole, None, size, stated or None))
                    continue
                digest = hashlib.sha256(body).hexdigest() if whole and body is not None else None
                good = digest is not None and stated in (None, "", digest)
                out.append((record_id, kind, refers_to, good, body if good else None, len(body) if good else None, digest if good else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * len(types), types)], names=[x.split()[0] for x in schema.split(", ")])

    return plain.unionByName(grouped).mapInArrow(join, schema)


def resolved(whole: DataFrame) -> DataFrame:
    """assemble()'s rows without payloads, revisits with the length and digest of the response that they refer to. A
    revisit is complete if that response is there and complete, and both agree with what the revisit states."""
    found = materialize(whole.drop("payload"), "warc-records")
    # of repeated rows, whose identifiers end in a number of their own, a revisit names the common part
    named = found.filter("type = 'response' and complete").groupBy(F.regexp_replace("record_id", r":r\d+>$", ">").alias("refers_to")).agg(F.first("payload_bytes").alias("r_bytes"), F.first("payload_digest").alias("r_digest"))
    named = materialize(named, "warc-responses")
    revisits = found.filter("type = 'revisit'").join(named, "refers_to", "left")
    agrees = F.col("payload_digest").eqNullSafe(F.col("r_digest")) & F.coalesce(F.col("payload_bytes") == F.col("r_bytes"), F.col("payload_bytes").isNull()) & F.col("r_digest").isNotNull()
    revisits = revisits.select("record_id", "type", "refers_to", (F.col("complete") & agrees).alias("complete"), F.col("r_bytes").alias("payload_bytes"), F.col("r_digest").alias("payload_digest"))
    return found.filter("type <> 'revisit'").select(*revisits.columns).unionByName(revisits)


def page_id(name: str):
    """The page's id inside a record's identifier."""
    return F.regexp_extract(name, _ID.pattern, 1).try_cast("long")


def round_trip(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write the archives, read them back, and return a row per page: page_id, payload_bytes, payload_digest,
    record_type, refers_to, complete."""
    spark = pages.sparkSession
    path = path or work_path(spark, "warc")
    write_warc(pages, path, **options)
    whole = resolved(assemble(read_records(spark, path)))
    return whole.select(page_id("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), page_id("refers_to").alias("refers_to"), "complete")
