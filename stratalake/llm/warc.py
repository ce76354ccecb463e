"""WARC archives: writing pages with revisits for equal payloads, and a salvaging reader.

Pages are written by the tasks that hold them, each task to archives of its own in a shared folder,
one gzip member per record. Of pages with equal payloads the one with the smallest id is a response
and the others are revisits that refer to it. What was written is known from the rows that
successful tasks return, so files of lost or repeated tasks are never read.

The reader checks each record: the member's checksum, the version line, the lengths and the
digests. After a failed check it looks for the next place that starts a member or a version line
and goes on from there, and it returns the bytes in between as a quarantined gap with the reason.
Within a member the version line is looked for in the inflated bytes, and the gap's reason names
their range. Of a member that is cut off or damaged, records are kept whose own digest proves them.
It reads plain and compressed records, in windows, and inflates members as streams, so an archive
or a member may be larger than memory; one record is held at a time.

Defined results: a null payload is empty; a null id or address leaves its field empty, and among
equal payloads ids come before nulls; rows that share the smallest id of a payload are all
responses; an empty archive or table gives no rows. Other columns are left out.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as stores
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stratalake.config import scratch_dir
from stratalake.llm.common import checkpointed, prepare_workers, written

ARCHIVE_BYTES = 64 << 20
LEAST_PAYLOAD = 0
LEVEL = 3
READ_BYTES = 1 << 20
INFLATED_AT_ONCE = 1 << 16
HEADER_WINDOW = 1 << 16

# Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
VERSION_LINE = re.compile(rb"WARC/\d+\.\d+\r\n")
MEMBER_START = b"\x1f\x8b\x08"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_END = b"\r\n\r\n"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# --- writing -----------------------------------------------------------------------------------


def _header_value(text: str) -> str:
    """Control characters would end the line."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record_bytes(page_id, url: str | None, payload: bytes, refers_to, date: str) -> bytes:
    """One record: a response with its payload, or a revisit of another page's payload."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", "sha1:" + sha1_base32(payload)),
        ("WARC-Block-Digest", "sha1:" + sha1_base32(block)),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", _header_value(url)))
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    fields.append(("Content-Length", str(len(block))))
    head = "".join(f"{k}: {v}\r\n" for k, v in fields).encode("utf-8", "replace")
    return VERSION + head + b"\r\n" + block + RECORD_END


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def store_of(uri: str) -> tuple[stores.FileSystem, str]:
    """The file system of a folder or file, as any worker can open it."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return stores.FileSystem.from_uri(uri)


def payload_of(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit("")).cast("binary")


def write_archives(
    pages: DataFrame,
    folder: str,
    id_column: str = "page_id",
    url_column: str = "url",
    text_column: str = "html",
    least_payload: int = LEAST_PAYLOAD,
    archive_bytes: int = ARCHIVE_BYTES,
    date: str = "2000-01-01T00:00:00Z",
) -> DataFrame:
    """Write all pages below a shared folder; returns (path, bytes, records) of the archives."""
    prepare_workers(pages.sparkSession)
    payload = payload_of(F.col(text_column))
    rows = pages.select(
        F.col(id_column).alias("id"),
        F.col(url_column).cast("string").alias("url"),
        payload.alias("payload"),
        F.sha1(payload).alias("digest"),
    )
    repeated = written(
        rows.filter(F.octet_length("payload") >= least_payload)
        .groupBy("digest")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .drop("n"),
        "warc-repeated",
    )
    refers_to = F.when(~F.col("first").eqNullSafe(F.col("id")), F.col("first"))
    planned = rows.join(repeated, "digest", "left").select("id", "url", "payload", refers_to.alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = store_of(folder)
        out, path, size, records = None, "", 0, 0
        try:
            for batch in batches:
                for page, url, data, first in zip(*(c.to_pylist() for c in batch.columns)):
                    if out is None:
                        store.create_dir(root, recursive=True)
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        path, size, records = f"{folder}/{name}", 0, 0
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    raw = member(record_bytes(page, url, data, first, date))
                    out.write(raw)
                    size, records = size + len(raw), records + 1
                    if size >= archive_bytes:
                        out.close()
                        out = None
                        yield _manifest(path, size, records)
            if out is not None:
                out.close()
                out = None
                yield _manifest(path, size, records)
        finally:
            if out is not None:
                out.close()

    return checkpointed(planned.mapInArrow(write, "path string, bytes long, records long"))


def _manifest(path: str, size: int, records: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"path": pa.array([path]), "bytes": pa.array([size], pa.int64()), "records": pa.array([records], pa.int64())}
    )


# --- reading -----------------------------------------------------------------------------------


class BadRecord(ValueError):
    """A check of a record failed."""


@dataclass
class Found:
    """A record, or a gap if it has a reason."""

    start: int
    end: int
    fields: dict[str, str]
    payload: bytes | None = None
    payload_bytes: int | None = None
    reason: str | None = None


class Archive:
    """Windows on a file that can be read at any place."""

    def __init__(self, file, size: int) -> None:
        self.file, self.size = file, size
        self.start, self.data = 0, b""

    def at(self, offset: int, length: int) -> bytes:
        """The bytes from an offset, fewer at the end of the file."""
        if not (self.start <= offset and offset + length <= self.start + len(self.data)):
            self.file.seek(offset)
            self.start, self.data = offset, self.file.read(max(length, READ_BYTES))
        begin = offset - self.start
        return self.data[begin : begin + length]


class Inflater:
    """The content of the gzip member at an offset, piece by piece."""

    def __init__(self, archive: Archive, offset: int) -> None:
        self.archive, self.at = archive, offset
        self.unpacker, self.reason, self.cut = zlib.decompressobj(31), None, False

    def more(self, limit: int) -> bytes:
        """Some next bytes; none at the end, which has a reason if it is not the member's own."""
        while not self.unpacker.eof and not self.reason:
            data = self.archive.at(self.at, min(INFLATED_AT_ONCE, READ_BYTES))
            before = self.unpacker.copy()
            try:
                out = self.unpacker.decompress(data, limit)
            except zlib.error as error:
                # What lies before the damage comes out with a smaller limit.
                self.unpacker = before
                if limit == 1:
                    self.reason = f"member is damaged: {error}"
                limit = max(1, limit // 2)
                continue
            rest = self.unpacker.unused_data if self.unpacker.eof else self.unpacker.unconsumed_tail
            self.at += len(data) - len(rest)
            if out:
                return out
            if not data and not self.unpacker.eof:
                self.reason, self.cut = "member is cut off", True
        return b""


class Member:
    """Windows on the content of a gzip member, like those on an archive.

    A first pass checks the member and measures it; the content is inflated again as it is read,
    unless it is small. Bytes from ``floor`` on are held, earlier ones are not read any more.
    """

    def __init__(self, archive: Archive, offset: int) -> None:
        self.archive, self.offset, self.floor = archive, offset, 0
        self.start, self.size, held = 0, 0, []
        self.inflater = Inflater(archive, offset)
        while part := self.inflater.more(READ_BYTES):
            self.size += len(part)
            if self.size <= READ_BYTES:
                held.append(part)
            else:
                held = []
        self.reason, self.end, self.cut = self.inflater.reason, self.inflater.at, self.inflater.cut
        self.data = b"".join(held)
        if self.size > READ_BYTES:
            self.inflater = Inflater(archive, offset)

    def at(self, offset: int, length: int) -> bytes:
        end = min(offset + length, self.size)
        have = self.start + len(self.data)
        if have < end:
            drop = max(0, min(self.floor, have) - self.start)
            self.start, parts = self.start + drop, [self.data[drop:]]
            while have < end and (part := self.inflater.more(READ_BYTES)):
                have += len(part)
                if have <= self.floor:
                    self.start, parts = have, []
                else:
                    parts.append(part)
            self.data = b"".join(parts)
        return self.data[offset - self.start : max(offset, end) - self.start]

    def read_up_to(self, content: int) -> int:
        """Where in the archive the bytes end that make so much of the content."""
        inflater, left = Inflater(self.archive, self.offset), content
        while left and (part := inflater.more(min(left, READ_BYTES))):
            left -= len(part)
        return inflater.at

    def next_version(self, offset: int) -> int:
        """The next place of a version line in the content, or the content's end."""
        while offset < self.size:
            self.floor = offset
            data = self.at(offset, READ_BYTES)
            for m in re.finditer(rb"WARC/\d", data):
                if VERSION_LINE.match(self.at(offset + m.start(), 32)):
                    return offset + m.start()
            if offset + len(data) >= self.size:
                break
            offset += max(1, len(data) - 8)  # a line may lie across two windows
        return self.size


def _head(read, start: int) -> tuple[dict[str, str], int]:
    """The fields of the header at a place, and its length with the empty line.

    The end is looked for window by window, as an address may have any length.
    """
    data = read(start, HEADER_WINDOW)
    first = VERSION_LINE.match(data)
    if not first:
        raise BadRecord("no version line")
    windows, last, end = [data], data, data.find(RECORD_END)
    while end < 0:
        tail = last[1 - len(RECORD_END) :]  # the end may lie across two windows
        length = sum(map(len, windows))
        last = read(start + length, HEADER_WINDOW)
        if not last:
            raise BadRecord("header has no end")
        windows.append(last)
        last = tail + last
        if (found := last.find(RECORD_END)) >= 0:
            end = length - len(tail) + found
    data, fields = b"".join(windows), {}
    for line in data[first.end() : end].decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon:
            raise BadRecord("header line has no colon")
        fields[name.strip().lower()] = value.strip()
    if not fields.get("content-length", "").isdigit():
        raise BadRecord("no content length")
    return fields, end + len(RECORD_END)


def _checked(fields: dict[str, str], block: bytes, start: int, end: int) -> Found:
    want = fields.get("warc-block-digest")
    if want and want.startswith("sha1:") and want != "sha1:" + sha1_base32(block):
        raise BadRecord("block digest differs")
    found = Found(start, end, fields)
    if fields.get("content-type", "").startswith("application/http"):
        http, gap, payload = block.partition(RECORD_END)
        if not gap:
            raise BadRecord("no end of the HTTP header")
        if fields.get("warc-type") == "response":
            found.payload, found.payload_bytes = payload, len(payload)
            want = fields.get("warc-payload-digest")
            if want and want.startswith("sha1:") and want != "sha1:" + sha1_base32(payload):
                raise BadRecord("payload digest differs")
        elif length := re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http):
            found.payload_bytes = int(length[1])
    else:
        found.payload, found.payload_bytes = block, len(block)
    return found


def _plain_record(read, size: int, start: int) -> Found:
    """The record at a place of plain bytes; ``read(offset, length)`` gives them."""
    fields, head = _head(read, start)
    length = int(fields["content-length"])
    if start + head + length + len(RECORD_END) > size:
        raise BadRecord("block is cut off")
    block = read(start + head, length)
    end = start + head + length + len(RECORD_END)
    if read(start + head + length, len(RECORD_END)) != RECORD_END:
        raise BadRecord("block does not end where it should")
    return _checked(fields, block, start, end)


def _proven(found: Found, member: Member) -> bool:
    """Whether a record of a cut or damaged member is kept: by its digest, which covers no header.

    A record that is all of a damaged member's content may owe the damage to its header.
    """
    alone = found.start == 0 and found.end == member.size and not member.cut
    return found.fields.get("warc-block-digest", "").startswith("sha1:") and not alone


def _member_records(member: Member) -> Iterator[Found]:
    """The records of a member that pass their checks, and the gaps between them.

    Their ``start`` and ``end`` are places in the content.
    """
    at, gap = 0, None
    while at < member.size:
        member.floor = at
        try:
            found = _plain_record(member.at, member.size, at)
            if member.reason and not _proven(found, member):
                raise BadRecord(member.reason)
        except BadRecord as error:
            end = member.next_version(at + 1)
            # The end of a damaged member has the member's reason.
            reason = member.reason if member.reason and end == member.size else str(error)
            gap = Found(gap.start if gap else at, end, {}, reason=gap.reason if gap else reason)
            at = end
            continue
        if gap:
            yield gap
            gap = None
        at = found.end
        yield found
    if gap:
        yield gap
    elif member.reason or not member.size:
        yield Found(at, at, {}, reason=member.reason or "member is empty")


def _starts_record(archive: Archive, offset: int) -> bool:
    """Whether a record may start here: a version line, or a member that begins with one."""
    data = archive.at(offset, 512)
    if data.startswith(MEMBER_START):
        try:
            data = zlib.decompressobj(31).decompress(data, 32)
        except zlib.error:
            return False
    return VERSION_LINE.match(data) is not None


def _next_start(archive: Archive, offset: int) -> int:
    """The next place from an offset at which a record may start, or the end of the file."""
    while offset < archive.size:
        data = archive.at(offset, READ_BYTES)
        for m in re.finditer(rb"\x1f\x8b\x08|WARC/\d", data):
            if _starts_record(archive, offset + m.start()):
                return offset + m.start()
        if offset + len(data) >= archive.size:
            break
        offset += max(1, len(data) - 8)  # a start may lie across two windows
    return archive.size


def _placed(found: Found, member: Member) -> Found:
    """A record or gap of a member with the member's place; a gap's reason tells the bytes."""
    if found.reason:
        found.reason += f" (bytes {found.start} to {found.end} of the member's content)"
    found.start, found.end = member.offset, member.end
    return found


def read_records(archive: Archive) -> Iterator[Found]:
    """All records that pass their checks, and the gaps between them.

    Records of one member have its start and end, the end of a damaged one being where inflating
    stopped; the gap after its last good record starts where that record's bytes end.
    """
    at, gap = 0, None
    while at < archive.size:
        member, passed, saved, lost = None, [], 0, None
        if archive.at(at, 3) == MEMBER_START:
            member = Member(archive, at)
            passed = _member_records(member)
        else:
            try:
                passed = [_plain_record(archive.at, archive.size, at)]
            except BadRecord as error:
                lost = Found(at, at, {}, reason=str(error))
        for found in passed:
            if found.reason:
                lost = found
                continue
            if gap:
                yield gap
                gap = None
            if lost:
                yield _placed(lost, member)
                lost = None
            saved = found.end
            yield _placed(found, member) if member else found
        if member and saved and not member.reason:
            if lost:
                yield _placed(lost, member)
            at = member.end
        elif lost:
            start = member.read_up_to(saved) if saved else at
            if member and not member.reason:
                end = member.end
            else:
                # An inflater may take a few bytes more than it needs.
                end = _next_start(archive, max(at + 1, start - 8))
            start = min(start, end)
            gap = Found(gap.start if gap else start, end, {}, reason=gap.reason if gap else lost.reason)
            at = end
        else:
            at = saved
    if gap:
        yield gap


_RECORDS = (
    "archive string, start long, end long, gap_reason string, record_type string, page_id string, "
    "target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary"
)


def _page(value: str | None) -> str | None:
    found = re.fullmatch(r"<urn:page:(.+)>", value or "")
    return found[1] if found else None


def read_archives(spark: SparkSession, archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records and gaps of the archives listed by ``path``, an archive to a task."""
    prepare_workers(spark)
    types = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 6, pa.int64(), pa.binary()]
    names = [part.split()[0] for part in _RECORDS.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, place = store_of(path)
                held, size = [], 0
                with store.open_input_file(place) as file:
                    for f in read_records(Archive(file, file.size())):
                        digest = f.fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
                        held.append(
                            (path, f.start, f.end, f.reason, f.fields.get("warc-type"), _page(f.fields.get("warc-record-id")),
                             f.fields.get("warc-target-uri"), _page(f.fields.get("warc-refers-to")), digest,
                             f.payload_bytes, f.payload if with_payload else None)
                        )
                        size += len(f.payload or b"") + 256
                        if size >= READ_BYTES:
                            yield _rows(held, types, names)
                            held, size = [], 0
                if held:
                    yield _rows(held, types, names)

    paths = archives.select("path")
    # As many tasks as archives: their few bytes of paths say nothing about the work.
    return paths.repartition(max(1, paths.count())).mapInArrow(read, _RECORDS)


def _rows(held: list[tuple], types: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives in the shared scratch folder."""
    return f"{scratch_dir(spark)}/warc-{uuid.uuid4().hex}"
