"""WARC archives: a writer with revisit records and a salvage reader.

The writer makes one gzip member per record and packs members into archives
of bounded size, which Spark's text writer puts into the folder byte by byte
(it adds one line feed after the last member). The reader checks every
member, record and digest; after a failed check it searches for the next
member or version line that passes them, goes on from there, and reports the
bytes between as a quarantined gap.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.llm.shared import shared_path, ship, stored, table

#: Payloads of fewer bytes are always kept whole.
MIN_REVISIT_BYTES = 100
#: An archive is closed at so many bytes; one record more may follow.
ARCHIVE_BYTES = 8 << 20
#: Written as the date of every record, as pages have none.
NO_DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP, VERSION = b"\x1f\x8b\x08", b"WARC/1."
VERSION_LINE, PLACES = re.compile(rb"WARC/1\.\d\r\n"), re.compile(rb"\x1f\x8b\x08|WARC/1\.\d\r\n")
LONGEST_MARK = len(b"WARC/1.0\r\n")
#: Bytes that are fed to the unpacker at a time, at first and at most.
FIRST_STEP, STEP = 1 << 7, 1 << 16
#: Bytes of a record's header at most (the format itself has no limit).
MAX_HEAD = 1 << 16
#: Bytes of a record or of a member's content at most; a row could not hold more than twice that.
MAX_CONTENT = 1 << 30
#: Bytes of an archive in one row on its way to the task that reads it, and of payloads in one batch of results.
CHUNK, BATCH_BYTES = 1 << 18, 1 << 24
#: What a row of results is taken to need besides its payload.
ROW_BYTES = 512
#: Endings of names that Spark's line reader takes for packed files.
PACKED = r"(?i)\.(gz|bz2|deflate|lz4|snappy|zst|zstd|passthrough)$"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    """One WARC record. Line breaks and blanks of a url are percent-encoded."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {NO_DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.insert(4, "WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class Broken(ValueError):
    """A check of a member or record failed."""


class Tape:
    """A stream of ``size`` bytes, read by their places through a window that moves on.

    ``get`` and the searches load what they need; ``forget`` drops what lies
    behind. Bytes after ``size`` are not read.
    """

    def __init__(self, chunks: Iterable[bytes], size: int) -> None:
        self.size, self.start, self.held = size, 0, bytearray()
        self._chunks = iter(chunks)
        self._no_head_end = (0, 0)

    def load(self, end: int) -> bool:
        """Load up to place ``end`` at least; false if the stream ends before."""
        while self.start + len(self.held) < end:
            chunk = next(self._chunks, None)
            if chunk is None:
                return False
            self.held += chunk[: self.size - self.start - len(self.held)]
        return True

    def get(self, a: int, b: int) -> bytes:
        self.load(min(b, self.size))
        return bytes(memoryview(self.held)[a - self.start : b - self.start])

    def forget(self, before: int) -> None:
        if before - self.start >= STEP:
            del self.held[: before - self.start]
            self.start = before

    def next_place(self, at: int, pattern: re.Pattern) -> int:
        """The first place from ``at`` on where a member or record may begin, or the size. Bytes before ``at`` go."""
        while True:
            self.forget(at)
            end = self.start + len(self.held)
            hit = pattern.search(self.held, at - self.start)
            if hit:
                return self.start + hit.start()
            at = max(at, end - LONGEST_MARK + 1)
            if not self.load(end + 1):
                return self.size

    def head_end(self, at: int) -> int:
        """The first blank line after ``at`` that ends a header of at most ``MAX_HEAD`` bytes, or -1.

        It is known how far there is none, so many headers without an end
        are not searched again and again.
        """
        a, b = self._no_head_end
        place = max(at, b) if a <= at <= b else at
        while place < at + MAX_HEAD:
            end = self.start + len(self.held)
            hit = self.held.find(b"\r\n\r\n", place - self.start)
            self._no_head_end = (at, self.start + hit if hit >= 0 else max(place, end - 3))
            if hit >= 0:
                return self.start + hit if self.start + hit < at + MAX_HEAD else -1
            place = max(place, end - 3)
            if not self.load(end + 1):
                return -1
        return -1


def _plain(tape: Tape, at: int) -> tuple[int, dict[str, str], bytes]:
    """(end, headers, block) of the record at ``at``; raises ``Broken``."""
    if tape.get(at, at + len(VERSION)) != VERSION or (head_end := tape.head_end(at)) < 0:
        raise Broken("no record header")
    headers = {}
    for line in tape.get(at, head_end).split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Broken("bad header line")
        headers[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    if not headers.get("content-length", "").isdecimal():
        raise Broken("no content length")
    start, end = head_end + 4, head_end + 4 + int(headers["content-length"])
    if end + 4 > tape.size:
        raise Broken("record is cut or its length is wrong")
    if end - start > MAX_CONTENT:
        raise Broken(f"record of more than {MAX_CONTENT} bytes")
    if tape.get(end, end + 4) != b"\r\n\r\n":
        raise Broken("record is cut or its length is wrong")
    block = tape.get(start, end)
    name, _, value = headers.get("warc-block-digest", "").partition(":")
    if name == "sha256" and hashlib.sha256(block).hexdigest() != value.lower():
        raise Broken("block digest differs")
    return end + 4, headers, block


def _steps(tape: Tape, at: int) -> Iterator[bytes]:
    """The bytes from ``at`` on in steps that grow, so that what is read past a member is no more than it has."""
    step = FIRST_STEP
    while piece := tape.get(at, min(at + step, tape.size)):
        yield piece
        at, step = at + len(piece), min(2 * step, STEP)


def _inflated(tape: Tape, at: int) -> tuple[bytes, int | None, str]:
    """Content, end and fault of the member at ``at``. If bad or cut it has no end, and the content is what comes before the fault."""
    unpacker, parts, total, place = zlib.decompressobj(31), [], 0, at
    for piece in _steps(tape, at):
        try:
            parts.append(unpacker.decompress(piece, MAX_CONTENT - total + 1))
        except zlib.error as e:
            return _before_fault(tape, at, place, piece), None, f"bad member: {e}"
        total, place = total + len(parts[-1]), place + len(piece)
        if total > MAX_CONTENT:
            return b"".join(parts), None, f"member is cut: more than {MAX_CONTENT} bytes of content"
        if unpacker.eof:
            return b"".join(parts), place - len(unpacker.unused_data), ""
    return b"".join(parts), None, "member is cut"


def _before_fault(tape: Tape, at: int, place: int, piece: bytes) -> bytes:
    """Content of the member at ``at`` up to the faulty byte, which is in ``piece`` at ``place``.

    A failing call gives nothing, so the piece is halved to find how much of it is good.
    """
    unpacker = zlib.decompressobj(31)
    parts = [unpacker.decompress(tape.get(at, place))]
    step = 1 << len(piece).bit_length()
    while step := step // 2:
        trial = unpacker.copy()
        try:
            parts.append(trial.decompress(piece[:step]))
        except zlib.error:
            continue
        unpacker, piece = trial, piece[step:]
    return b"".join(parts)


def _records(inner: Tape, digested: bool) -> Iterator[tuple[str, int, int, object]]:
    """Records of a member's content and the gaps between; if ``digested`` only records with a block digest pass."""

    def one(at: int) -> tuple[int, dict[str, str], bytes]:
        end, headers, block = _plain(inner, at)
        if digested and not headers.get("warc-block-digest", "").startswith("sha256:"):
            raise Broken("no block digest in a bad member")
        return end, headers, block

    at = 0
    while at < inner.size:
        start, reason, got = at, "", None
        while at < inner.size and got is None:
            try:
                got = one(at)
            except Broken as e:
                reason = reason or str(e)
                at = inner.next_place(at + 1, VERSION_LINE)
        if reason:
            yield "gap", start, at, reason
        if not got:
            return
        yield "record", at, got[0], got[1:]
        at = got[0]


def _one(tape: Tape, at: int) -> tuple[int | None, list[tuple[str, object]]]:
    """End, if it is certain, and records and gaps of the member or plain record at ``at``."""
    if tape.get(at, at + len(GZIP)) != GZIP:
        try:
            end, headers, block = _plain(tape, at)
        except Broken as e:
            return None, [("gap", str(e))]
        return end, [("record", (headers, block))]
    inner, end, fault = _inflated(tape, at)
    found: list[tuple[str, object]] = []
    for kind, a, b, what in _records(Tape([inner], len(inner)), digested=fault.startswith("bad")):
        if kind == "record":
            found.append((kind, what))
        elif end is not None or b < len(inner):
            found.append((kind, f"bytes {a} to {b} of the member's content: {what}"))
    if fault == "member is cut" and [k for k, _ in found] == ["record"] and b == len(inner):
        found = []  # a member of one record fails with its check
    return end, found if end is not None else [*found, ("gap", fault)]


def salvage(data: bytes | Tape) -> Iterator[tuple[str, int, int, object]]:
    """("record", start, end, (headers, block)) and ("gap", start, end, reason).

    Every byte is in one of them, but for a line feed at the very end. The
    records of a member, and the gaps between them, have the member's range;
    a bad or cut member's reaches to where the reader goes on. A cut member
    whose content is just one record is a gap, whatever the record's digest.

    A stream is read once, in time linear in its size. What is held of it is a
    member with its content, or a record, neither of more than ``MAX_CONTENT``
    bytes; what is larger is a gap, up to the next that passes its checks.
    """
    tape = data if isinstance(data, Tape) else Tape([data], len(data))
    at, ready = 0, None
    while at < tape.size and not (at == tape.size - 1 and tape.get(at, at + 1) == b"\n"):
        tape.forget(at)
        end, found = ready or _one(tape, at)
        ready = None
        if end is None:
            end = at + 1
            while ready is None and (end := tape.next_place(end, PLACES)) < tape.size:
                whole, inside = _one(tape, end)
                if any(kind == "record" for kind, _ in inside) or (whole is not None and not inside):
                    ready = whole, inside
                else:
                    end += 1
        for kind, what in found:
            yield kind, at, end, what
        at = end


def write_archives(pages: DataFrame, path: str) -> None:
    """Write rows of (page_id, url, payload, digest, refers_to, revisit).

    Each task packs its rows into archives, one output row and file each.
    """

    def pack(batches):
        members, size = [], 0
        for batch in batches:
            for page_id, url, payload, digest, refers_to, revisit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                members.append(gzip_member(record(page_id, url, payload, digest, refers_to, revisit)))
                size += len(members[-1])
                if size >= ARCHIVE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(members)], pa.binary())], names=["archive"])
                    members, size = [], 0
        if members:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(members)], pa.binary())], names=["archive"])

    rows = pages.select("page_id", "url", F.col("payload").cast("binary").alias("payload"), "digest", "refers_to", "revisit")
    archives = rows.mapInArrow(pack, "archive binary")
    archives.select(F.col("archive").cast("string")).write.option("maxRecordsPerFile", 1).option("compression", "none").text(path)


ARCHIVE_ROWS = (
    "file string, start long, end long, reason string, record_type string, record_id string, target_uri string, "
    "refers_to string, payload_digest string, payload_bytes long, payload binary"
)


def _streamed(spark: SparkSession, path: str) -> DataFrame:
    """(file, size, block, number, chunk) of the archives, each in one task in the order of its bytes.

    The files are read as lines in parallel, whatever bytes they hold, and the lines
    of a split joined to chunks again; so no file is ever held whole.
    """

    def join(batches):
        files, sizes, blocks, numbers, chunks = [], [], [], [], []
        lines, held, number, of = [], 0, 0, None
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

        def close():
            nonlocal lines, held, number
            if lines:
                for column, value in zip((files, sizes, blocks, numbers, chunks), (*of, number, b"".join(lines)), strict=True):
                    column.append(value)
                lines, held, number = [], 0, number + 1

        def batch_of():
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((files, sizes, blocks, numbers, chunks), kinds, strict=True)], names=names)
            for column in (files, sizes, blocks, numbers, chunks):
                column.clear()
            return made

        for batch in batches:
            for *split, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if split != of:
                    close()
                    of, number = split, 0
                lines += (line, b"\n")
                held += len(line) + 1
                if held >= CHUNK:
                    close()
            if files:
                yield batch_of()
        close()
        if files:
            yield batch_of()

    names = ["file", "size", "block", "number", "chunk"]
    lines = spark.read.option("lineSep", "\n").text(path).where(~F.col("_metadata.file_name").rlike(PACKED))
    split = [F.col(f"_metadata.{c}") for c in ("file_path", "file_size", "file_block_start")]
    chunks = lines.select(*split, F.col("value").cast("binary")).mapInArrow(join, "file string, size long, block long, number long, chunk binary")
    return chunks.repartition("file").sortWithinPartitions("file", "block", "number")


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record, or per gap (then only file, start, end and reason).

    ``payload_digest`` and ``payload_bytes`` come from the payload itself; a
    revisit record has none, so they are those its headers state. A response
    whose payload is not what its digest says is reported as a gap.

    An archive is streamed through one task. One whose name ends like that of a
    packed file (``.gz``) is loaded whole, as Spark's line reader would unpack it
    and fail with the first bad member: at most 2 GB, and what an executor
    holds; give larger ones another name.
    """
    ship(spark)
    names = [c.split()[0] for c in ARCHIVE_ROWS.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 6, pa.int64(), pa.binary()]

    def rows(file, tape):
        for kind, start, end, found in salvage(tape):
            if kind == "gap":
                yield (file, start, end, found, *[None] * 7)
                continue
            headers, block = found
            http, cut, payload = block.partition(b"\r\n\r\n")
            if not headers.get("content-type", "").startswith("application/http") or not cut:
                http, payload = b"", block
            digest = headers.get("warc-payload-digest", "").partition(":")[2]
            size, kept = len(payload), payload
            if headers.get("warc-type") == "revisit":
                length = re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)
                size, kept = int(length[1]) if length else None, None
            else:
                actual = hashlib.sha256(payload).hexdigest()
                if digest and actual != digest:
                    yield (file, start, end, "payload digest differs", *[None] * 7)
                    continue
                digest = actual
            named = [headers.get(k) for k in ("warc-type", "warc-record-id", "warc-target-uri", "warc-refers-to")]
            yield (file, start, end, None, *named, digest, size, kept if with_payload else None)

    def batches_of(found):
        some, held = [], 0
        for row in found:
            some.append(row)
            held += ROW_BYTES + len(row[-1] or b"")
            if held >= BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some, strict=True), kinds, strict=True)], names=names)
                some, held = [], 0
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some, strict=True), kinds, strict=True)], names=names)

    def read_stream(batches):
        chunks = ((file, size, chunk.as_py()) for b in batches for file, size, chunk in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(4), strict=True))
        yield from batches_of(row for (file, size), own in groupby(chunks, lambda c: c[:2]) for row in rows(file, Tape((c[2] for c in own), size)))

    def read_whole(batches):
        whole = ((file, data.as_py()) for b in batches for file, data in zip(b.column(0).to_pylist(), b.column(1), strict=True))
        yield from batches_of(row for file, data in whole for row in rows(file, Tape([data], len(data))))

    packed = spark.read.format("binaryFile").load(path).where(F.element_at(F.split("path", "/"), -1).rlike(PACKED))
    return (
        _streamed(spark, path).mapInArrow(read_stream, ARCHIVE_ROWS)
        .unionByName(packed.select("path", "content").mapInArrow(read_whole, ARCHIVE_ROWS))
    )


def with_revisits(pages: DataFrame) -> DataFrame:
    """Adds payload, digest, refers_to and revisit to (page_id, url, html).

    Of equal payloads of ``MIN_REVISIT_BYTES`` or more the smallest page_id
    is the response (each row of it, if repeated); the others, rows with a
    null id too, revisit it. Null html is an empty payload. The digests are
    pre-aggregated and stored, so a payload that a third of the pages share
    is a skewed join of two plain shuffles, which adaptive execution splits.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    keyed = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    long_enough = F.octet_length("payload") >= MIN_REVISIT_BYTES
    firsts = keyed.where(long_enough).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    firsts = stored(firsts.where("n > 1 AND first IS NOT NULL").select("digest", "first"), "warc-firsts")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return keyed.join(firsts, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit")
    )


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back from them."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("long"), "url", "html")
    path = shared_path(spark, "warc")
    write_archives(with_revisits(pages), path)
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    back = read_archives(spark, path, with_payload=False).where("reason IS NULL")
    return back.select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to")
    )


OP5_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""
