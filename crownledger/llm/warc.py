"""WARC archives: a writer with revisits, and a reader that salvages what it can from damaged files.

The reader checks every record: the member's CRC, the version line, the header's length against the content, and the
block digest. After a failed check it searches for the next place where a whole record can be read, a
compressed member or a version line, goes on from there and reports the bytes between as a gap. A member may hold many records;
it is unpacked piece by piece, first to check it and then to read its records, so that memory holds one record, of ``RECORD_BYTES`` at most.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crownledger.llm.files import Roller, opened
from crownledger.llm.text import as_bytes, schema
from crownledger.session import work_folder
from crownledger.sources.scratch import written

LEAST_BYTES = 100  # smaller payloads are stored every time
READ = 1 << 18
HEAD = 1 << 20  # the longest header of a record
RECORD_BYTES = 1 << 30  # the longest record that is read; a longer one is a gap
BATCH_BYTES = 8 << 20
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
BEGIN = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class Damaged(Exception):
    """No whole record begins here."""


@dataclass
class Record:
    """``offset`` and ``length`` are those in the file; records that share a member have its, and ``inner`` tells where they begin in it."""

    offset: int
    length: int
    headers: dict[str, str]
    block: bytes
    inner: int = 0

    @property
    def payload(self) -> bytes:
        """The block without the head of its HTTP message."""
        return self.block.partition(b"\r\n\r\n")[2] if self.headers.get("content-type", "").startswith("application/http") else self.block

    @property
    def http_length(self) -> int:
        found = re.search(rb"(?i)\r\ncontent-length:[ \t]*(\d+)", self.block.partition(b"\r\n\r\n")[0])
        return int(found[1]) if found else len(self.payload)


@dataclass
class Gap:
    offset: int
    length: int
    reason: str
    inner: int = 0


def build(kind: str, record_id: str, uri: str, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    """One record as a compressed member. A revisit holds the head of the HTTP message only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if kind == "response" else head
    fields = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<{record_id}>",
        "WARC-Date": date,
        "WARC-Target-URI": re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri),
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
    }
    if refers_to is not None:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<{refers_to}>"}
    fields["Content-Length"] = str(len(block))
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields.items())
    return packer.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def _headers(head: bytes) -> dict[str, str]:
    headers = {}
    for line in head.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header")
        headers[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    return headers


class Bytes:
    """A stream that is read piece by piece: of a file from ``offset`` on, or of what a member there holds."""

    def __init__(self, file: pa.NativeFile, offset: int, packed: bool):
        self.file, self.at, self.held, self.taken = file, offset, b"", 0
        self.unpack = zlib.decompressobj(31) if packed else None

    def more(self) -> bool:
        """Reads one more piece; False at the end."""
        unpack = self.unpack
        if unpack is None:
            piece = self.file.read_at(READ, self.at)
            self.at += len(piece)
        elif unpack.eof:
            return False
        else:
            try:
                given = unpack.unconsumed_tail or self.file.read_at(READ, self.at)
                self.at += 0 if unpack.unconsumed_tail else len(given)
                piece = unpack.decompress(given, READ)
            except zlib.error as e:
                raise Damaged("member") from e
            if not given:
                raise Damaged("member")
            if not piece:
                return not unpack.eof
        self.held += piece
        return bool(piece)

    def fill(self, n: int) -> bool:
        """Whether ``n`` bytes are held, after reading on if need be."""
        if len(self.held) < n:
            parts, size = [self.held], len(self.held)
            while size < n:
                self.held = b""
                if not self.more():
                    break
                parts.append(self.held)
                size += len(self.held)
            self.held = b"".join(parts)
        return len(self.held) >= n

    def take(self, n: int) -> bytes:
        out, self.held = self.held[:n], self.held[n:]
        self.taken += len(out)
        return out


def _member(file: pa.NativeFile, offset: int) -> tuple[int, int]:
    """End in the file and unpacked size of the whole member that begins at ``offset``."""
    stream = Bytes(file, offset, True)
    if not VERSION.match(stream.held) and stream.fill(10) and not VERSION.match(stream.held):
        raise Damaged("version")
    stream.take(len(stream.held))
    while stream.more():
        stream.take(len(stream.held))
    return stream.at - len(stream.unpack.unused_data), stream.taken


def _record(stream: Bytes, left: int) -> tuple[dict[str, str], bytes]:
    """The record that begins in the stream, of which at most ``left`` bytes are to come."""
    if not stream.fill(10) or not VERSION.match(stream.held):
        raise Damaged("version")
    while b"\r\n\r\n" not in stream.held:
        if len(stream.held) >= HEAD or not stream.fill(len(stream.held) + 1):
            raise Damaged("header")
    begin = stream.held.index(b"\r\n\r\n") + 4
    headers = _headers(stream.held[: begin - 4])
    size = headers.get("content-length", "")
    if not size.isdecimal() or len(size) > 18 or begin + int(size) + 4 > min(left, RECORD_BYTES) or not stream.fill(begin + int(size) + 4):
        raise Damaged("length")
    end = begin + int(size)
    block = stream.held[begin:end]
    if stream.held[end : end + 4] != b"\r\n\r\n":
        raise Damaged("length")
    digest = headers.get("warc-block-digest", "")
    if digest.startswith("sha256:") and digest[7:] != hashlib.sha256(block).hexdigest():
        raise Damaged("digest")
    stream.take(end + 4)
    return headers, block


def records_at(file: pa.NativeFile, offset: int, size: int) -> tuple[int, Iterator[Record | Gap]]:
    """Where the record or member at ``offset`` ends, and what it holds: a whole record at first, or it is :class:`Damaged`."""
    if not file.read_at(2, offset) == b"\x1f\x8b":
        stream = Bytes(file, offset, False)
        headers, block = _record(stream, size - offset)
        return offset + stream.taken, iter([Record(offset, stream.taken, headers, block)])
    end, inside = _member(file, offset)
    stream = Bytes(file, offset, True)
    first = Record(offset, end - offset, *_record(stream, inside))

    def rest() -> Iterator[Record | Gap]:
        yield first
        begin, reason = stream.taken, ""
        while stream.taken < inside:
            at = stream.taken
            try:
                headers, block = _record(stream, inside - at)
            except Damaged as e:
                reason = reason or str(e)
                # on to the next version line, held in pieces of READ
                stream.take(1)
                while stream.fill(10) and not (found := VERSION.search(stream.held)):
                    stream.take(max(1, len(stream.held) - 9))
                stream.take(found.start() if len(stream.held) >= 10 and found else len(stream.held))
                continue
            if at > begin:
                yield Gap(offset, end - offset, reason, begin)
            yield Record(offset, end - offset, headers, block, at)
            begin, reason = stream.taken, ""
        if begin < inside:
            yield Gap(offset, end - offset, reason, begin)

    return end, rest()


def salvage(file: pa.NativeFile, size: int) -> Iterator[Record | Gap]:
    """All whole records of a file in order, and the gaps between them; together they cover the file."""
    offset = 0
    while offset < size:
        try:
            end, records = records_at(file, offset, size)
        except Damaged as e:
            begin, reason = offset, str(e)
            offset, found = _next(file, offset + 1, size)
            yield Gap(begin, offset - begin, reason)
            if found is None:
                return
            end, records = found
        yield from records
        offset = end


def _next(file: pa.NativeFile, offset: int, size: int) -> tuple[int, tuple[int, Iterator[Record | Gap]] | None]:
    """The first place from ``offset`` on where a whole record begins, with what is there; the end of the file if none does."""
    while offset < size:
        chunk = file.read_at(READ, offset)
        for begin in BEGIN.finditer(chunk):
            try:
                return offset + begin.start(), records_at(file, offset + begin.start(), size)
            except Damaged:
                pass
        if offset + len(chunk) >= size:
            break
        offset += len(chunk) - 9  # a version line may lie across the end of the chunk
    return size, None


def write_archives(pages: DataFrame, folder: str, least: int = LEAST_BYTES, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write (page_id, url, html) as archives under ``folder``; the manifest (uri, bytes, records) names the files.

    Of pages with equal payloads of at least ``least`` bytes, that with the smallest page_id is a response and
    the others revisit it; smaller ones are all responses. Null html is an empty payload; a null id is never
    the smallest, except among nulls, which are then all responses. Rows that repeat the smallest id
    are responses too. Ids are kept in the record ids.
    """
    own = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), as_bytes("html").alias("payload"))
    own = own.withColumn("digest", F.unhex(F.sha2("payload", 256)))
    large = own.filter(F.octet_length("payload") >= least)
    firsts = written(
        large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1 and first is not null").drop("n")
    )
    rows = own.join(firsts.withColumnRenamed("digest", "of"), F.col("digest") == F.col("of"), "left")
    rows = rows.select("page_id", "url", "payload", "digest", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = Roller(folder, ".warc.gz")
        for batch in batches:
            for page, url, payload, digest, first in zip(*batch.columns, strict=True):
                refers = first.as_py()
                name = "urn:x-page:" + ("" if page.as_py() is None else str(page.as_py()))
                kind = "response" if refers is None else "revisit"
                to = None if refers is None else f"urn:x-page:{refers}"
                files.write(build(kind, name, url.as_py(), payload.as_py(), digest.as_py().hex(), to, date))
        files.close()
        columns = list(zip(*files.closed, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)], ["uri", "bytes", "records"])

    return written(rows.mapInArrow(run, schema(uri="string", bytes="long", records="long")))


#: One row per record or gap; ``reason`` is set for gaps only, the fields after it for records only.
FOUND = schema(
    uri="string", offset="long", length="long", reason="string", type="string", record_id="string", target="string",
    refers_to="string", payload_bytes="long", payload_digest="string", payload="binary",
)


def read_archives(files: DataFrame, payloads: bool = True) -> DataFrame:
    """The records and gaps (:data:`FOUND`) of all files named in the column ``uri``, read one record at a time.

    A response whose payload does not have the digest in its header is a gap. Without ``payloads`` the payload column is null.
    """
    kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.string(), pa.binary()]

    def rows(uri: str) -> Iterator[tuple]:
        system, path = opened(uri)
        with system.open_input_file(path) as file:
            for found in salvage(file, file.size()):
                if isinstance(found, Gap):
                    yield uri, found.offset, found.length, found.reason, *[None] * 7
                    continue
                fields, payload = found.headers, found.payload
                kind, said = fields.get("warc-type"), fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
                if kind == "response":
                    digest = hashlib.sha256(payload).hexdigest()
                    if said and said != digest:
                        yield uri, found.offset, found.length, "payload digest", *[None] * 7
                        continue
                    size, said = len(payload), digest
                else:
                    size = found.http_length
                names = [fields.get(n, "").strip("<>") or None for n in ("warc-record-id", "warc-target-uri", "warc-refers-to")]
                yield uri, found.offset, found.length, None, kind, *names, size, said, payload if payloads else None

    def packed(part: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part, strict=True), kinds, strict=True)], FOUND.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                part, size = [], 0
                for row in rows(uri):
                    part.append(row)
                    size += 200 + len(row[-1] or b"")
                    if size > BATCH_BYTES:
                        yield packed(part)
                        part, size = [], 0
                if part:
                    yield packed(part)

    return files.select("uri").mapInArrow(run, FOUND)


def op8_warc(pages: DataFrame) -> DataFrame:
    """The contract's columns, all from the records that were read back."""
    files = write_archives(pages, work_folder(pages.sparkSession))
    named = F.regexp_extract("record_id", r"^urn:x-page:(-?\d*)$", 1)
    return (
        read_archives(files.repartition(max(1, files.count())), payloads=False)
        .filter("reason is null")
        .select(
            F.nullif(named, F.lit("")).cast("long").alias("page_id"),
            "payload_bytes",
            "payload_digest",
            F.col("type").alias("record_type"),
            F.regexp_extract("refers_to", r"(-?\d+)$", 1).cast("long").alias("refers_to"),
        )
    )


ORACLE_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NOT NULL AND first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM f
"""
