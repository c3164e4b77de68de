import gzip
import hashlib

import pytest

from millrace.llm import warc
from millrace.llm.common import work_path

SCHEMA = "page_id long, url string, html string"


def want(rows):
    first = {}
    for i, _, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(h or "", i)
    out = []
    for i, _, h in rows:
        body = (h or "").encode()
        revisit = len(body) >= 100 and first[h or ""] != i
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", first[h] if revisit else None, True))
    return sorted(out, key=str)


ROWS = [
    (5, "http://a/\r\nx", "p" * 200),
    (3, "http://b", "p" * 200),
    (9, None, "p" * 200),
    (1, "u", "short"),
    (2, "u", "short"),
    (4, "u", None),
    (6, "u", ""),
    (7, "u", "é漢\U0001f600" * 5_000),
    (8, "u", "x WARC/1.1\r\n\r\nWARC/1.1\r\n0\r\n\r\n tail" * 40),
    (10, "u", "y" * 99),
    (11, "u", "y" * 99),
    (None, "u", "z" * 150),
    (12, "u", "z" * 150),
]


@pytest.mark.parametrize("segment,chunk", [(16_384, 4_096), (100, 7), (1, 1_000_000)])
def test_round_trip(spark, segment, chunk):
    rows = ROWS if segment > 1 else ROWS[:7]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as record_id", "2 as body", "3 as digest", "4 as id")
    found = warc.round_trip(df.repartition(3), segment_bytes=segment, chunk_bytes=chunk)
    assert sorted((tuple(r) for r in found.collect()), key=str) == want(rows)


def test_repeated_rows_and_none(spark):
    df = spark.createDataFrame([(1, "u", "q" * 120)] * 3 + [(2, "u", "q" * 120)], SCHEMA)
    found = [tuple(r)[:5] for r in warc.round_trip(df, segment_bytes=50).collect()]
    assert sorted(x[3] for x in found) == ["response"] * 3 + ["revisit"] and all(x[1] == 120 for x in found)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_files_are_gzip_archives(spark):
    path = work_path(spark, "warc")
    warc.write_warc(spark.createDataFrame(ROWS[:3], SCHEMA).coalesce(1), path)
    name = spark.read.format("binaryFile").load(path).first().path.removeprefix("file:")
    data = gzip.open(name).read()
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: ") and data.endswith(b"\r\n\r\n") and data.count(b"WARC-Record-ID") == 3


def segment(number, block, origin=None, total=None, kind="response"):
    return ("<o>" if origin is None else f"<c{number}>", kind if origin is None else "continuation", origin, number, total, None, "", block)


MESSAGE = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3\r\nabc\r\n0\r\n\r\n"


@pytest.mark.parametrize(
    "parts,payload",
    [
        ([segment(2, MESSAGE[20:], "<o>", len(MESSAGE)), segment(1, MESSAGE[:20])], b"abc"),
        ([segment(1, MESSAGE[:20]), segment(2, MESSAGE[20:], "<o>", len(MESSAGE)), segment(2, MESSAGE[20:], "<o>", len(MESSAGE))], b"abc"),
        ([segment(1, MESSAGE[:20]), segment(3, MESSAGE[20:], "<o>", len(MESSAGE))], None),
        ([segment(1, MESSAGE[:20]), segment(2, MESSAGE[20:], "<o>", len(MESSAGE) + 1)], None),
        ([segment(1, MESSAGE[:20]), segment(2, MESSAGE[20:-9], "<o>", len(MESSAGE) - 9)], None),
        ([segment(2, MESSAGE[20:], "<o>", len(MESSAGE))], None),
    ],
)
def test_reassembly(spark, parts, payload):
    row = warc.assemble(spark.createDataFrame(parts, warc.RECORD)).first()
    assert (bytes(row.payload) if row.payload is not None else None, row.complete) == (payload, payload is not None)


@pytest.mark.parametrize("body", [b"", b"a", b"ab\r\ncd" * 50])
@pytest.mark.parametrize("size", [1, 3, 1000])
def test_chunks(body, size):
    assert warc.dechunked(warc.chunked(body, size)) == body
    assert warc.dechunked(warc.chunked(body, size)[:-6]) is None or not body
    assert warc.dechunked(warc.chunked(body, size)[:-2]) is None
    assert warc.dechunked(warc.chunked(body, size)[:-2] + b"Expires: never\r\n\r\n") == body


def test_revisits_are_held_against_their_response(spark):
    """Length and digest of a revisit are the response's; without it, or if they differ, the revisit is not complete."""
    body = b"abc"
    digest = hashlib.sha256(body).hexdigest()
    stated = lambda n: b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % n
    rows = [("<r>", "response", None, None, None, None, digest, MESSAGE), ("<a>", "revisit", None, None, None, "<r>", digest, stated(3))]
    rows += [("<b>", "revisit", None, None, None, "<gone>", digest, stated(3)), ("<c>", "revisit", None, None, None, "<r>", "00", stated(3)), ("<d>", "revisit", None, None, None, "<r>", digest, stated(4))]
    found = {r.record_id: (r.payload_bytes, r.payload_digest, r.complete) for r in warc.resolved(warc.assemble(spark.createDataFrame(rows, warc.RECORD))).collect()}
    assert found == {"<r>": (3, digest, True), "<a>": (3, digest, True), "<b>": (None, None, False), "<c>": (3, digest, False), "<d>": (3, digest, False)}


def test_records_in_many_pieces():
    data = b"WARC-Type: response\r\nContent-Length: 40\r\n\r\n" + b"x" * 10 + (warc.VERSION + b"y") * 3 + b"\r\n\r\n"
    pieces = data.split(warc.VERSION)
    record = warc.Record(pieces[0])
    for piece in pieces[1:]:
        assert not record.whole
        record.add(piece)
    assert record.whole and record.block() == (b"x" * 10 + (warc.VERSION + b"y") * 3 + b"\r\n\r\n")[:40]
