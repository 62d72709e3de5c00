"""WARC archives of pages: written one gzip member per record, read back sequentially and verified.

A record of an equal payload is stored once, as a response; the others are revisits that refer to it.
The reader holds one chunk of an archive at a time: members are inflated bit by bit, the block is framed
by its Content-Length, and digests are taken as its bytes pass.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.session import new_path

from .base import BATCH_ROWS, keep, lean

#: Payloads of fewer bytes than this are never revisits.
LEAST_BYTES = 0
#: An archive is closed when it has this many compressed bytes; it is what one task reads.
ARCHIVE_BYTES = 64 << 20
#: Bytes of an archive held at once, and bytes inflated at once.
CHUNK = 1 << 18
#: Pages carry no time of capture.
DATE = "2000-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

END = b"\r\n\r\n"


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(page_id: int | None) -> str:
    """The same for every row of a page_id, so that a revisit can name its response before that is written."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'page:{page_id}'.encode()).digest())}>"


def plan_records(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, payload (binary; NULL for a revisit), payload_bytes, payload_sha1 (hex), refers_to.

    Reads page_id, url and html only.  NULL html is an empty payload.  Of the rows with an equal payload of
    ``least_bytes`` or more, those with the largest page_id are responses and the others revisit it; a NULL
    page_id is never the largest, and rows that share only NULL ids are all responses.  Equality is that of
    a SHA-256 and the length.  Groups are summed before the shuffle and joined back as a written table, which
    Spark broadcasts if small and else splits where a payload is frequent.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("mark", F.unhex(F.sha2("payload", 256)))
    groups = rows.where(F.col("payload_bytes") >= least_bytes).groupBy("mark", "payload_bytes")
    groups = groups.agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1 and top is not null")
    groups = keep(groups.select(F.col("mark").alias("group_mark"), F.col("payload_bytes").alias("group_bytes"), "top"), "warc-groups")
    equal = (F.col("mark") == F.col("group_mark")) & (F.col("payload_bytes") == F.col("group_bytes"))
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("top")), F.col("top"))
    joined = rows.join(groups, equal, "left").withColumn("refers_to", refers_to)
    return joined.select(
        "page_id", "url", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"), "payload_bytes",
        F.sha1("payload").alias("payload_sha1"), "refers_to",
    )


def _filesystem(uri: str) -> tuple[FileSystem, str]:
    """The store of a path or URI (local, HDFS, object stores) and the path in it."""
    return FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    lines = [b"WARC/1.1", *(f"{name}: {value}".encode() for name, value in headers), b"Content-Length: %d" % len(block)]
    packed = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packed.compress(b"\r\n".join(lines) + END) + packed.compress(block) + packed.compress(END) + packed.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes | None, size: int, sha1: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """The record of a page.  A revisit's block is the HTTP head alone, as its payload is that of its response."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size + (payload or b"")
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", date)]
    if url is not None:  # a header line holds no control characters
        headers.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url)))
    if page_id is not None:
        headers.append(("Page-ID", str(page_id)))
    headers.append(("WARC-Payload-Digest", f"sha1:{base32_sha1(sha1)}"))
    headers.append(("WARC-Block-Digest", f"sha1:{base32_sha1(hashlib.sha1(block).digest())}"))
    if refers_to is not None:
        headers += [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    headers.append(("Content-Type", "application/http; msgtype=response"))
    return member(headers, block)


def write_archives(records: DataFrame, archive_bytes: int = ARCHIVE_BYTES, folder: str | None = None) -> DataFrame:
    """Write the rows of ``plan_records`` as archives; file, records, bytes of each, as a written table.

    Files lie in a new folder under the shared one, named anew by each attempt of a task.  Only files of
    attempts that came to their end are in the table, so that lost executors, repeated and speculative tasks
    leave files that nobody reads.  Each file begins with a warcinfo record, which does not count.
    """
    folder = folder or new_path(records.sparkSession, "warc")

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _filesystem(folder)
        store.create_dir(path)
        done: list[tuple[str, int, int]] = []
        out, name, rows, size = None, "", 0, 0
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in ("page_id", "url", "payload", "payload_bytes", "payload_sha1", "refers_to")]
            for page_id, url, payload, n, sha1, refers_to in zip(*columns, strict=True):
                if out is None:
                    name, rows = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{path}/{name}", compression=None)
                    info = b"software: lotwise\r\nformat: WARC File Format 1.1\r\n"
                    headers = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE), ("WARC-Filename", name)]
                    first = member([*headers, ("Content-Type", "application/warc-fields")], info)
                    out.write(first)
                    size = len(first)
                data = page_record(page_id, url, payload, n, bytes.fromhex(sha1), refers_to)
                out.write(data)
                rows, size = rows + 1, size + len(data)
                if size >= archive_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", rows, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", rows, size))
        yield pa.RecordBatch.from_pydict({k: [d[i] for d in done] for i, k in enumerate(("file", "records", "bytes"))}, schema=_FILES)

    return keep(records.mapInArrow(run, "file string, records long, bytes long"), "warc-files")


_FILES = pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])


class Damaged(ValueError):
    """An archive cannot be read on: its gzip stream or its framing is broken."""


class Members:
    """The gzip members of a stream, one after the other, a chunk at a time."""

    def __init__(self, stream, chunk: int = CHUNK):
        self.stream, self.chunk, self.rest, self.offset = stream, chunk, b"", 0

    def next(self) -> bool:
        """Go to the next member; False at the end of the archive."""
        if not self.rest:
            self.rest = self.stream.read(self.chunk)
        self.inflate, self.head = zlib.decompressobj(31), b""
        return bool(self.rest)

    def _more(self) -> bytes:
        """Some more bytes of this member; none at its end."""
        while not self.inflate.eof:
            if not self.rest:
                self.rest = self.stream.read(self.chunk)
                if not self.rest:
                    raise Damaged("the archive ends inside a member")
            before = len(self.rest)
            try:
                out = self.inflate.decompress(self.rest, self.chunk)
            except zlib.error as error:
                raise Damaged(f"gzip: {error}") from None
            self.rest = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            self.offset += before - len(self.rest)
            if out:
                return out
        return b""

    def until(self, mark: bytes) -> bytes:
        """What comes before the mark, which is skipped."""
        while mark not in self.head:
            more = self._more()
            if not more:
                raise Damaged("a member ends inside the head of its record")
            self.head += more
        out, _, self.head = self.head.partition(mark)
        return out

    def take(self, size: int) -> Iterator[bytes]:
        """The next ``size`` bytes in pieces."""
        while size:
            piece, self.head = (self.head or self._more()), b""
            if not piece:
                raise Damaged("a member ends inside its block")
            piece, self.head = piece[:size], piece[size:]
            size -= len(piece)
            yield piece

    def left(self) -> bytes:
        """What follows the block, read to the end of the member."""
        out, self.head = self.head, b""
        while more := self._more():
            out = (out + more)[: len(END) + 1]
        return out


@dataclass
class Record:
    offset: int
    headers: dict[str, str] = field(default_factory=dict)
    payload_bytes: int | None = None
    payload_digest: str | None = None
    payload: bytes | None = None
    fault: str | None = None


def _fields(head: bytes) -> dict[str, str]:
    """Header lines by lower-cased name."""
    lines = (line.partition(b":") for line in head.split(b"\r\n")[1:])
    return {name.strip().lower().decode(errors="replace"): value.strip().decode(errors="replace") for name, _, value in lines}


def _length(headers: dict[str, str], what: str) -> int:
    stated = headers.get("content-length", "")
    if not re.fullmatch("[0-9]{1,18}", stated):
        raise Damaged(f"{what} states no Content-Length")
    return int(stated)


def _read_one(members: Members, record: Record, payloads: bool) -> None:
    head = members.until(END)
    if not head.startswith(b"WARC/"):
        raise Damaged("no WARC record")
    record.headers = headers = _fields(head)
    kind, http = headers.get("warc-type"), headers.get("content-type", "").startswith("application/http")
    block, payload, kept = hashlib.sha1(), hashlib.sha1(), []
    start, inside, size = b"", not http, 0
    for piece in members.take(_length(headers, "a record")):
        block.update(piece)
        if not inside:
            start += piece
            if END not in start:
                continue
            first, _, piece = start.partition(END)
            inside, start = True, first
        payload.update(piece)
        size += len(piece)
        if payloads and kind != "revisit":
            kept.append(piece)
    found = {"block": base32_sha1(block.digest()), "payload": base32_sha1(payload.digest())}
    stated = {k: headers[f"warc-{k}-digest"].removeprefix("sha1:") for k in found if f"warc-{k}-digest" in headers}
    if kind == "revisit":  # the payload lies in another record
        if http:
            size = _length(_fields(start), "a revisit's HTTP head")
        record.payload_bytes, record.payload_digest = size, stated.pop("payload", None)
    else:
        record.payload_bytes, record.payload_digest = size, found["payload"]
        record.payload = b"".join(kept) if payloads else None
    wrong = [k for k, digest in stated.items() if digest != found[k]]
    if http and not inside:
        wrong.append("HTTP head")
    if members.left() != END:
        wrong.append("record end")
    record.fault = f"wrong {', '.join(wrong)}" if wrong else None


def read_records(stream, payloads: bool = False, chunk: int = CHUNK) -> Iterator[Record]:
    """The records of one archive in order.  A record whose digest or end is wrong says so in ``fault`` and
    reading goes on; where the stream itself is broken, the last record says so and reading ends."""
    members = Members(stream, chunk)
    while members.next():
        record = Record(members.offset)
        try:
            _read_one(members, record, payloads)
        except Damaged as damage:
            record.fault = str(damage)
            yield record
            return
        yield record


_READ = pa.schema([
    ("file", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("headers", pa.map_(pa.string(), pa.string())),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("fault", pa.string()),
])
READ = (
    "file string, offset long, record_type string, headers map<string,string>, payload_bytes long, payload_digest string, "
    "payload binary, fault string"
)


def read_archives(files: DataFrame, payloads: bool = False, chunk: int = CHUNK) -> DataFrame:
    """All records of the archives named in the column ``file``, one row each (columns of ``READ``).

    An archive is read by one task, from its first byte to its last.  headers has lower-cased names.
    payload_digest is the digest found (of a revisit: the one it states), payload is given if asked for, and
    fault says what is wrong, NULL if all is well.  Files may be of any writer; an empty file has no records.
    """
    count = files.count()

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("file").to_pylist():
                store, path = _filesystem(file)
                rows, held = [], 0
                with store.open_input_stream(path, compression=None) as stream:
                    for r in read_records(stream, payloads, chunk):
                        headers = list(r.headers.items())
                        rows.append((file, r.offset, r.headers.get("warc-type"), headers, r.payload_bytes, r.payload_digest, r.payload, r.fault))
                        held += len(r.payload or b"")
                        if len(rows) == BATCH_ROWS or held >= 16 * chunk:
                            yield _read_batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _read_batch(rows)

    return files.select("file").repartition(max(count, 1)).mapInArrow(run, READ)


def _read_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _READ.types, strict=True)], schema=_READ)


def _header(name: str) -> Column:
    return F.element_at("headers", F.lit(name))


def page_verdicts(read: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the response and revisit records.

    A revisit is resolved by the record id that it names; refers_to is the page_id found there.  Fails on a
    record with a fault, and on a revisit whose response is missing or has another payload digest.
    """
    sound = F.when(F.col("fault").isNotNull(), F.raise_error(F.concat(F.col("file"), F.lit(": "), F.col("fault")))).otherwise(F.col("payload_digest"))
    rows = read.where("record_type is null or record_type in ('response', 'revisit')").select(
        _header("page-id").cast("long").alias("page_id"), "payload_bytes", sound.alias("payload_digest"), "record_type",
        _header("warc-record-id").alias("id"), _header("warc-refers-to").alias("refers_id"),
    )
    rows = keep(rows, "warc-records")
    asked = rows.where("record_type = 'revisit'").drop("id")
    first = rows.where("record_type = 'response'").groupBy("id").agg(F.min("page_id").alias("refers_to"), F.min("payload_digest").alias("first_digest"))
    found = asked.join(keep(first, "warc-responses"), F.col("refers_id") == F.col("id"), "left")
    unequal = ~F.col("first_digest").eqNullSafe(F.col("payload_digest"))
    checked = F.when(unequal, F.raise_error(F.concat(F.lit("unresolved revisit of "), F.coalesce("refers_id", F.lit("nothing"))))).otherwise(F.col("refers_to"))
    revisits = found.select("page_id", "payload_bytes", "payload_digest", "record_type", checked.alias("refers_to"))
    responses = rows.where("record_type = 'response'").select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
    return responses.unionByName(revisits)


def archive_pages(pages: DataFrame, least_bytes: int = LEAST_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages`` as archives, read them back and return ``page_verdicts``, one row per row of ``pages``.

    An empty table writes no archive and gives an empty result; very long payloads are written as one member
    and pass the reader in chunks; extra columns are ignored.  Rows that repeat a page_id share a record id.
    """
    files = write_archives(plan_records(pages, least_bytes), archive_bytes)
    return page_verdicts(read_archives(files))
