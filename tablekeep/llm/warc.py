"""WARC archives of pages: written by a Spark job, read back by a reader that salvages what it can.

Writing: a page is one record in a gzip member of its own, and a task strings members together to archives of bounded size.
The archive is a cell that Spark's text writer puts into a file as it is, so its commit protocol holds and any file system
that Spark knows will do; a file ends with an empty gzip member (the row separator). Of pages with equal payloads of
``LEAST_SHARED`` bytes or more the one with the smallest id is stored, the others are revisits that refer to it.

Reading: an archive is walked member by member (or version line by version line, where it is not compressed). A record
counts if its member's checksum, its version line, header lines, length, closing line ends and block digest are right. After
a failed check the reader searches for the next place where a member or version line begins that passes all of them, goes
on from there, and tells the bytes between as a quarantined gap with the reason. Work is in proportion to the archive, but
for false beginnings inside a gap, each of which is tried until its first failed check.

Defined cases: a null html is an empty payload; a null or empty url is written as ``urn:page:<id>``; control characters and blanks
in a url are percent-encoded; a page without id is a response if no page with an id has its payload, else a revisit; copies
of the page with the smallest id are all responses; repeated pages are records each; payloads may hold line ends, version
lines and gzip magic; empty archives, and tables without rows, give no records and no gaps; other columns are ignored. An
archive to be read must be below 2 GB (one cell), and so must a payload.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekeep.operators.matching import fits_broadcast
from tablekeep.llm.common import settled
from tablekeep.session import Workspace, col

LEAST_SHARED = 100
ARCHIVE_BYTES = 32 * 1024 * 1024
# Pages carry no time of their own.
DATE = "2000-01-01T00:00:00Z"

# Fixed values of the formats: version line, end of a record, profile of revisits, beginning of a gzip member.
VERSION = b"WARC/1.1"
LINE_END = b"\r\n"
RECORD_END = b"\r\n\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = b"\x1f\x8b\x08"
VERSION_LINE = re.compile(rb"WARC/[0-9]+\.[0-9]+\r\n")
BEGINNING = re.compile(rb"\x1f\x8b\x08|WARC/[0-9]+\.[0-9]+\r\n")
HEADER_LINE = re.compile(rb"([!#$%&'*+.^_`|~0-9A-Za-z-]+):[ \t]*([^\r\n]*)")
# Fixed value: the only header that a record may have more than once.
MAY_REPEAT = {"warc-concurrent-to"}
# A separator of rows that is no byte of any record: a gzip member without content.
EMPTY_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x02\xff\x03\x00\x00\x00\x00\x00\x00\x00\x00\x00"

# Copies of a row that tells of a repeated payload, so that the pages of one payload are spread over so many tasks.
SPREAD = 32
REPEATED_ROW_BYTES = 256

CHUNK = 1 << 16
# Bytes of a header line, at most: a search for its end does not go through a whole archive.
LONGEST_LINE = 1 << 20


# ---- records as bytes


def record_id(page_id: int | None, digest: str) -> str:
    """The same for a page whoever asks, so that a revisit can name the record it refers to."""
    h = hashlib.sha256(f"{page_id}/{digest}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-8{h[13:16]}-a{h[17:20]}-{h[20:32]}>"


def safe_uri(url: str) -> str:
    """Without characters that would end or bend a header line."""
    bent = lambda c: c <= " " or "\x7f" <= c <= "\x9f"
    return "".join("".join(f"%{b:02X}" for b in c.encode()) if bent(c) else c for c in url)


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response with the payload, or a revisit without it, whose http header tells its length."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    headers = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": record_id(page_id, digest),
        "WARC-Date": DATE,
        "WARC-Target-URI": safe_uri(url) if url else f"urn:page:{'' if page_id is None else page_id}",
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Length": str(len(block)),
    }
    if page_id is not None:
        headers["Page-ID"] = str(page_id)
    if refers_to is not None:
        headers["WARC-Profile"] = SAME_PAYLOAD
        headers["WARC-Refers-To"] = record_id(refers_to, digest)
        headers["Refers-To-Page-ID"] = str(refers_to)
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in headers.items())]
    return LINE_END.join(lines) + RECORD_END + block + RECORD_END


def member(data: bytes) -> bytes:
    """``data`` as a gzip member without a time, so that equal records are equal bytes."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class Damaged(Exception):
    """A failed check, and what it was."""


@dataclass
class Record:
    """A record that passed its checks, and the bytes of the archive that hold it."""

    start: int
    end: int
    headers: dict[str, str] = field(default_factory=dict)
    block: bytes = b""


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers (names in lower case), block and end of the plain record that begins at ``at``."""
    version = VERSION_LINE.match(data, at)
    if not version:
        raise Damaged("no version line")
    headers, here = {}, version.end()
    while True:
        end = data.find(LINE_END, here, here + LONGEST_LINE)
        if end < 0:
            raise Damaged("header without end")
        if end == here:
            break
        line = HEADER_LINE.fullmatch(data, here, end)
        if not line:
            raise Damaged("no header line")
        name = line[1].decode().lower()
        # A header cut short runs into that of the next record.
        if name in headers and name not in MAY_REPEAT:
            raise Damaged("header line twice")
        headers[name] = line[2].decode("utf-8", "replace").strip(" \t")
        here = end + 2
    length = headers.get("content-length", "")
    if not re.fullmatch("[0-9]{1,18}", length):
        raise Damaged("no length")
    start, end = here + 2, here + 2 + int(length)
    if data[end : end + 4] != RECORD_END:
        raise Damaged("block of another length")
    block = bytes(data[start:end])
    said = headers.get("warc-block-digest", "").partition(":")
    if said[0].lower() == "sha256" and said[2].lower() != hashlib.sha256(block).hexdigest():
        raise Damaged("block of another digest")
    return headers, block, end + 4


def open_member(data: memoryview, at: int) -> tuple[bytes, int]:
    """Content and end of the gzip member that begins at ``at``, its checksum and length checked."""
    inflate, parts = zlib.decompressobj(31), []
    here = at
    while not inflate.eof:
        piece = data[here : here + CHUNK]
        if not len(piece):
            raise Damaged("member without end")
        try:
            parts.append(inflate.decompress(piece))
        except zlib.error:
            raise Damaged("member of another checksum or no deflate data") from None
        here += len(piece)
    return b"".join(parts), here - len(inflate.unused_data)


def records_at(data: bytes, at: int) -> tuple[list[Record], int]:
    """All records of the member, or the one plain record, that begins at ``at``, and where it ends."""
    if not data.startswith(MAGIC, at):
        headers, block, end = parse_record(data, at)
        return [Record(at, end, headers, block)], end
    content, end = open_member(memoryview(data), at)
    out, here = [], 0
    while here < len(content):
        headers, block, here = parse_record(content, here)
        out.append(Record(at, end, headers, block))
    return out, end


def salvaged(data: bytes) -> Iterator[Record | tuple[int, int, str]]:
    """Records in their order, and ``(start, end, reason)`` of each gap between those that pass their checks."""
    here = 0
    while here < len(data):
        try:
            found, end = records_at(data, here)
        except Damaged as failed:
            start, reason, found, end, here = here, str(failed), [], len(data), len(data)
            for next_one in BEGINNING.finditer(data, start + 1):
                try:
                    found, end = records_at(data, next_one.start())
                except Damaged:
                    continue
                here = next_one.start()
                break
            yield start, here, reason
            if here == len(data):
                return
        yield from found
        here = end


# ---- writing


def _payload() -> Column:
    return F.coalesce(F.col("html"), F.lit("")).cast("binary")


def decided(pages: DataFrame, ws: Workspace) -> DataFrame:
    """``page_id, url, html, digest, refers_to`` (null: a response).

    Only payloads that occur twice are looked up. Few of them are broadcast, and the pages do not move; many are joined,
    each told ``SPREAD`` times, so that the pages of one payload, however many, are in as many groups.
    """
    given = pages.select(col("page_id").cast("long").alias("page_id"), col("url").cast("string").alias("url"), col("html").cast("string").alias("html"))
    given = given.withColumn("digest", F.sha2(_payload(), 256))
    long_ones = given.where(F.octet_length(_payload()) >= LEAST_SHARED)
    groups = long_ones.groupBy("digest").agg(F.count("*").alias("n"), F.min("page_id").alias("first"))
    repeated = settled(groups.where("n > 1 and first is not null").select("digest", "first"), ws, "repeated")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to")
    if fits_broadcast(pages.sparkSession, repeated.count() * REPEATED_ROW_BYTES):
        joined = given.join(F.broadcast(repeated), "digest", "left")
    else:
        told = repeated.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
        part = F.pmod(F.xxhash64("page_id", "url"), F.lit(SPREAD)).cast("int")
        joined = given.withColumn("part", part).join(told, ["digest", "part"], "left")
    return joined.select("page_id", "url", "html", "digest", refers)


def write_archives(pages: DataFrame, folder: str, ws: Workspace, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write a record per row of ``page_id, url, html`` into archives below ``folder`` (replaced), one file each."""

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            columns = [batch.column(name) for name in ("page_id", "url", "html", "digest", "refers_to")]
            for row in zip(*columns):
                page_id, url, html, digest, refers_to = (cell.as_py() for cell in row)
                held.append(member(page_record(page_id, url, (html or "").encode(), digest, refers_to)))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield pa.RecordBatch.from_pydict({"archive": [b"".join(held)]})
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pydict({"archive": [b"".join(held)]})

    cells = decided(pages, ws).mapInArrow(archives, "archive binary").select(F.col("archive").cast("string").alias("value"))
    writer = cells.write.mode("overwrite").option("maxRecordsPerFile", 1)
    # Bytes go into the file as they are; the separator is the last member of each file.
    writer.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1")).text(folder)


# ---- reading


SALVAGED = pa.schema(
    [
        ("path", pa.string()),
        ("start", pa.int64()),
        ("end", pa.int64()),
        ("gap", pa.string()),
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
    ]
)


def _number(text: str | None) -> int | None:
    number = int(text) if text and re.fullmatch("-?[0-9]{1,19}", text) else None
    return number if number is not None and -(1 << 63) <= number < 1 << 63 else None


def described(path: str, r: Record, payloads: bool) -> tuple:
    """A row of ``SALVAGED``: of a response by the payload itself, of a revisit by what its headers say."""
    head, _, payload = r.block.partition(RECORD_END)
    http = dict(re.findall(rb"(?m)^([A-Za-z-]+):[ \t]*([^\r\n]*)", head.lower()))
    kind = r.headers.get("warc-type")
    if kind == "revisit":
        size = _number(http.get(b"content-length", b"").decode("latin-1"))
        digest, payload = r.headers.get("warc-payload-digest", "").partition(":")[2], None
    else:
        # Records that hold no http message are payload all through.
        payload = payload if "application/http" in r.headers.get("content-type", "") else r.block
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
    ids = (_number(r.headers.get(name)) for name in ("page-id", "refers-to-page-id"))
    page_id, refers_to = ids
    return path, r.start, r.end, None, page_id, r.headers.get("warc-target-uri"), kind, refers_to, size, digest, payload if payloads else None


def salvage(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Every record and every gap of the archives below ``folder``, with the bytes ``start`` to ``end`` where it lies.

    ``gap`` is the reason of a gap, and null of a record. A task reads whole archives, one after another.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                rows, held = [], 0
                for found in salvaged(content.as_py()):
                    if isinstance(found, Record):
                        rows.append(described(path.as_py(), found, payloads))
                        held += len(found.block) if payloads else 0
                    else:
                        rows.append((path.as_py(), *found, *[None] * 7))
                    if len(rows) >= 4096 or held >= ARCHIVE_BYTES:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    archives = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "content")
    return archives.mapInArrow(read, _ddl())


def _ddl() -> str:
    names = {pa.string(): "string", pa.int64(): "long", pa.binary(): "binary"}
    return ", ".join(f"`{f.name}` {names[f.type]}" for f in SALVAGED)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), SALVAGED)], schema=SALVAGED)


def read_archives(spark: SparkSession, folder: str, ws: Workspace, payloads: bool = True) -> tuple[DataFrame, DataFrame]:
    """The records, and the log of quarantined gaps (``path, start, end, gap``), from one walk over the archives."""
    found = settled(salvage(spark, folder, payloads), ws, "salvaged")
    return found.where("gap is null").drop("gap"), found.where("gap is not null").select("path", "start", "end", "gap")


def archived(pages: DataFrame, ws: Workspace) -> DataFrame:
    """Write all pages as archives and read them back: per page its payload's size and digest, and how it is stored."""
    folder = ws.path("archives")
    write_archives(pages, folder, ws)
    records, _ = read_archives(pages.sparkSession, folder, ws, payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
