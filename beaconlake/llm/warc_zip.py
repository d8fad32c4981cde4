"""WARC records in ZIP archives: written, and read back by range without unpacking.

An archive is a ZIP file of stored members: ``archive/data.warc.gz`` (each record is a gzip member of its own) and
``indexes/index.cdx`` (one line per record: id, offset, length). The reader finds the end record, the ZIP64 records where
there are any, and the central directory; takes the members' places from there; reads the index; and then reads each
record as a byte range of the archive.

Archives live in a Parquet table (archive, content) in the shared folder, so every store that Spark can write holds them;
``ZipReader`` reads any object with ``read_at`` and works on files in the same way. A partition fills an archive up to
``ARCHIVE_BYTES`` and starts the next, so a task holds one archive at a time.

Of records with equal payloads the one with the smallest id is a response and the others are revisits of it, which hold
headers only. Finding them needs the digest of each payload alone: digests are grouped with a map-side combine, and the
join back has one row per digest that repeats. That list is broadcast if it is small; beyond that, adaptive execution
splits a payload that many pages share.

Defined results: a null html is an empty payload; equal ids with equal payloads are written each, and each is a response
(it is the smallest); a null id is written as an empty name and read back as null; it is a response only where no id with
that payload is known; header values drop line breaks. An empty table gives no archives and no rows.
"""

from __future__ import annotations

import base64
import gzip
import io
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.llm.common import broadcast_if_small, table, written

ARCHIVE_BYTES = 4 << 20
MIN_DEDUP_BYTES = 0
WARC_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdx"

END, END64, LOCATOR64, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


# ---- ZIP ----

def zip_stored(members: list[tuple[str, bytes]], zip64: bool = False) -> bytes:
    """A ZIP file of stored members; ``zip64`` writes the 64-bit records, which large archives need."""
    out, directory = io.BytesIO(), io.BytesIO()
    for name, data in members:
        big = zip64 or len(data) >= FULL32 or out.tell() >= FULL32
        raw, offset, crc = name.encode(), out.tell(), zlib.crc32(data)
        size = FULL32 if big else len(data)
        place = FULL32 if big else offset
        version = 45 if big else 20
        local_extra = struct.pack("<HHQQ", 1, 16, len(data), len(data)) if big else b""
        extra = struct.pack("<HHQQQ", 1, 24, len(data), len(data), offset) if big else b""
        common = struct.pack("<HHHHHIII", version, 0x800, 0, 0, 0x21, crc, size, size)
        out.write(LOCAL + common + struct.pack("<HH", len(raw), len(local_extra)) + raw + local_extra + data)
        directory.write(CENTRAL + struct.pack("<H", version) + common)
        directory.write(struct.pack("<HHHHHII", len(raw), len(extra), 0, 0, 0, 0, place) + raw + extra)
    start, length, count = out.tell(), directory.tell(), len(members)
    out.write(directory.getvalue())
    if zip64 or start >= FULL32 or count >= FULL16:
        place = out.tell()
        out.write(END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, count, count, length, start))
        out.write(LOCATOR64 + struct.pack("<IQI", 0, place, 1))
        count, length, start = FULL16, FULL32, FULL32
    out.write(END + struct.pack("<HHHHIIH", 0, 0, count, count, length, start, 0))
    return out.getvalue()


class Bytes:
    """``read_at`` over bytes in memory; a file object with ``seek`` and ``read`` can stand behind ``File`` instead."""

    def __init__(self, data: bytes):
        self._data, self.size = memoryview(data), len(data)

    def read_at(self, offset: int, length: int) -> bytes:
        return bytes(self._data[offset:offset + length])


class File:
    """``read_at`` over a seekable binary file."""

    def __init__(self, handle):
        self._handle, self.size = handle, handle.seek(0, 2)

    def read_at(self, offset: int, length: int) -> bytes:
        self._handle.seek(offset)
        return self._handle.read(length)


class ZipReader:
    """Places of stored members, from the central directory; bytes are read only by range."""

    def __init__(self, source):
        self.source = source
        self.members = {name: (offset, size) for name, offset, size in self._directory()}

    def _end(self) -> tuple[int, int, int]:
        """(entries, offset, length) of the central directory."""
        tail_at = max(0, self.source.size - 22 - FULL16)
        tail = self.source.read_at(tail_at, self.source.size - tail_at)
        at = len(tail)
        while (at := tail.rfind(END, 0, at)) >= 0:
            if at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
                break
        if at < 0:
            raise ValueError("no end of central directory")
        _, _, _, count, length, offset, _ = struct.unpack_from("<HHHHIIH", tail, at + 4)
        if count == FULL16 or length == FULL32 or offset == FULL32:
            locator = self.source.read_at(tail_at + at - 20, 20)
            if locator[:4] == LOCATOR64:
                place = struct.unpack_from("<Q", locator, 8)[0]
                end64 = self.source.read_at(place, 56)
                if end64[:4] != END64:
                    raise ValueError("no ZIP64 end of central directory")
                count, length, offset = struct.unpack_from("<QQQ", end64, 32)
        return count, offset, length

    def _directory(self) -> Iterator[tuple[str, int, int]]:
        count, offset, length = self._end()
        data, at = self.source.read_at(offset, length), 0
        for _ in range(count):
            if data[at:at + 4] != CENTRAL:
                raise ValueError("broken central directory")
            method, = struct.unpack_from("<H", data, at + 10)
            packed, size = struct.unpack_from("<II", data, at + 20)
            n_name, n_extra, n_comment = struct.unpack_from("<HHH", data, at + 28)
            place, = struct.unpack_from("<I", data, at + 42)
            name = data[at + 46:at + 46 + n_name].decode()
            extra = data[at + 46 + n_name:at + 46 + n_name + n_extra]
            at += 46 + n_name + n_extra + n_comment
            size, packed, place = self._wide(extra, size, packed, place)
            if method != 0:
                continue  # only stored members can be read by range
            head = self.source.read_at(place, 30)
            if head[:4] != LOCAL:
                raise ValueError("no local header")
            own_name, own_extra = struct.unpack_from("<HH", head, 26)
            yield name, place + 30 + own_name + own_extra, packed

    @staticmethod
    def _wide(extra: bytes, size: int, packed: int, place: int) -> tuple[int, int, int]:
        """The 64-bit values, of which the extra field holds those that do not fit 32 bits, in this order."""
        at, values = 0, [size, packed, place]
        while at + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, at)
            if kind == 1:
                inside = at + 4
                for i, value in enumerate(values):
                    if value == FULL32:
                        values[i], inside = struct.unpack_from("<Q", extra, inside)[0], inside + 8
            at += 4 + n
        return values[0], values[1], values[2]

    def read(self, name: str, offset: int = 0, length: int | None = None) -> bytes:
        start, size = self.members[name]
        return self.source.read_at(start + offset, size - offset if length is None else length)


# ---- WARC ----

def _line(value) -> str:
    return "" if value is None else str(value).replace("\r", " ").replace("\n", " ")


def _record_id(page_id) -> str:
    return f"<urn:page:{_line(page_id)}>"


def warc_record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """A gzipped response, or a revisit when ``refers_to`` is given; a revisit keeps the HTTP headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Target-URI: {_line(url)}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_record_id(refers_to)}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 1, mtime=0)


def _headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")[1:]
    return {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}


def parse_record(data: bytes) -> dict:
    """Headers and payload of one gzipped record."""
    raw = gzip.decompress(data)
    head, _, rest = raw.partition(b"\r\n\r\n")
    warc = _headers(head)
    http, _, payload = rest[:int(warc["content-length"])].partition(b"\r\n\r\n")
    return {"warc": warc, "http": _headers(http), "payload": payload}


def _of_id(record_id: str | None) -> int | None:
    value = (record_id or "")[len("<urn:page:"):-1]
    return int(value) if value else None


ARCHIVES = "archive string, records bigint, content binary"
RECORDS = (
    "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
    "payload binary"
)


def pack_archives(batches: Iterator[pa.RecordBatch], archive_bytes: int = ARCHIVE_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows (page_id, url, html, sha1, refers_to) to archives; one archive is held at a time."""
    warc, index, count = io.BytesIO(), io.StringIO(), 0

    def archive() -> pa.RecordBatch:
        members = [(WARC_MEMBER, warc.getvalue()), (INDEX_MEMBER, index.getvalue().encode())]
        content = zip_stored(members, zip64=True)
        name = f"{zlib.crc32(content):08x}-{len(content)}"
        return pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([count], pa.int64()), pa.array([content], pa.binary())], ["archive", "records", "content"]
        )

    for batch in batches:
        for row in zip(*(batch.column(i) for i in range(batch.num_columns))):
            page_id, url, html, sha1, refers_to = (x.as_py() for x in row)
            digest = base64.b32encode(bytes.fromhex(sha1)).decode()
            record = warc_record(page_id, url, (html or "").encode(), digest, refers_to)
            index.write(f"{_line(page_id)} {warc.tell()} {len(record)}\n")
            warc.write(record)
            count += 1
            if warc.tell() >= archive_bytes:
                yield archive()
                warc, index, count = io.BytesIO(), io.StringIO(), 0
    if count:
        yield archive()


def read_archives(batches: Iterator[pa.RecordBatch], with_payload: bool) -> Iterator[pa.RecordBatch]:
    """Archives to records: index from the directory, then each record by its range. Batches end at some megabytes."""
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    for batch in batches:
        for content in batch.column("content"):
            reader, rows, held = ZipReader(Bytes(content.as_py())), [], 0
            for line in reader.read(INDEX_MEMBER).decode().splitlines():
                offset, length = map(int, line.rsplit(" ", 2)[1:])
                record = parse_record(reader.read(WARC_MEMBER, offset, length))
                warc, payload = record["warc"], record["payload"]
                rows.append((
                    _of_id(warc["warc-record-id"]), warc["warc-target-uri"], int(record["http"]["content-length"]),
                    warc["warc-payload-digest"].partition(":")[2], warc["warc-type"], _of_id(warc.get("warc-refers-to")),
                    payload if with_payload else None,
                ))
                held += len(payload) if with_payload else 100
                if held >= ARCHIVE_BYTES:
                    yield flush(rows)
                    rows, held = [], 0
            if rows:
                yield flush(rows)


def first_copies(pages: DataFrame, min_bytes: int = MIN_DEDUP_BYTES) -> DataFrame:
    """``pages`` (page_id, url, html) with ``sha1`` and ``refers_to``: the smallest id with that payload, if another's."""
    html = F.coalesce("html", F.lit(""))
    keyed = pages.select("page_id", "url", html.alias("html"), F.sha1(html).alias("sha1"))
    large = F.octet_length("html") >= min_bytes
    copies = keyed.where(large).groupBy("sha1").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    # Payloads that occur once need no look-up: only digests of copies, and rows that have one, are of interest.
    copies = copies.where("n > 1").select("sha1", "first")
    joined = keyed.join(broadcast_if_small(written(copies, "warc-copies")), "sha1", "left")
    other = large & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "html", "sha1", F.when(other, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, min_bytes: int = MIN_DEDUP_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """The written table (archive, records, content) of all pages."""
    rows = first_copies(pages, min_bytes)
    return written(rows.mapInArrow(lambda batches: pack_archives(batches, archive_bytes), ARCHIVES), "warc-archives")


def records(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Every record of the archives, in the columns of ``RECORDS``; payloads of revisits are empty."""
    return archives.select("content").mapInArrow(lambda batches: read_archives(batches, with_payload), RECORDS)


def op7_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back: size and digest of its payload, record type, what it revisits."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    back = records(write_archives(pages), with_payload=False)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
