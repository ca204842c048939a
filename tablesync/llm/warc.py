"""WARC archives: one gzip member per record, written and read in sequence.

Writing turns rows into response records; of equal payloads only the one with the largest id keeps
its payload, the others become revisit records that name it. Reading decompresses member by member in
small steps, frames each record by its Content-Length, and verifies the block digest of every record
and the payload digest of every response. A revisit keeps the HTTP headers, so the size of the full
payload is known from it too.

Archives go to the folder all executors share. A task writes under names of its own attempt, and the
table of finished archives decides which of them count, so lost or repeated tasks leave no trace.

Edge cases: null payloads are empty ones; null urls give records without a target; equal payloads
under one repeated id are all responses; a null id is never the largest, and comes back null; an empty
table gives no archive and no rows; other columns of the input are never read. A damaged archive
raises `BadRecord` with its path and position.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.base import file_system, settled
from tablesync.session import workspace

LEAST_REVISIT = 1000  # payloads below this many bytes are always written in full
ARCHIVE_BYTES = 64 << 20  # an archive is closed once it is this long
STEP = 1 << 16  # bytes read, and at most decompressed, at once
MOST_TASKS = 100_000

RECORDS = "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint"


class BadRecord(ValueError):
    """An archive that breaks the format, or whose content does not match its digests."""


def described(pages: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    """page_id, url, payload and, for payloads to be written as a revisit, the id referred to."""
    body = F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8")
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), body.alias("payload"))
    rows = rows.select(
        "page_id", "url", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("digest"))
    # What is written in full anyway gets a key of its own, so that small equal payloads do not meet.
    own = F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string"))
    rows = rows.withColumn("same", F.when(F.col("payload_bytes") >= LEAST_REVISIT, F.col("digest")).otherwise(own))
    largest = (
        rows.filter(F.col("payload_bytes") >= LEAST_REVISIT).groupBy("same")
        .agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    )
    known = rows.join(largest, "same", "left")
    refers = F.when(F.coalesce(F.col("page_id") < F.col("largest"), F.col("largest").isNotNull()), F.col("largest"))
    return known.select("page_id", "url", "payload", "payload_bytes", "digest", refers.alias("refers_to"))


def _b32(digest: bytes) -> bytes:
    return b"sha1:" + base64.b32encode(digest)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record, not yet compressed."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    name = f"urn:page:{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid4()}"
    head = [
        b"WARC/1.1", b"WARC-Type: " + (b"response" if refers_to is None else b"revisit"),
        b"WARC-Record-ID: <%s>" % name.encode(), b"WARC-Date: %s" % date.encode(),
        b"WARC-Payload-Digest: " + _b32(bytes.fromhex(digest)), b"WARC-Block-Digest: " + _b32(hashlib.sha1(block).digest()),
        b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block),
    ]
    if url is not None:
        head.append(b"WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A").encode())
    if refers_to is not None:
        head.append(b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(b"WARC-Refers-To: <urn:page:%d>" % refers_to)
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def write(pages: DataFrame, key: str, url: str, payload: str, level: int = 4, date: str = "2026-01-01T00:00:00Z") -> DataFrame:
    """Write one record per row; the table of archives (path, records, bytes)."""
    folder = workspace(pages.sparkSession, "warc")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, inner = file_system(folder)
        system.create_dir(inner, recursive=True)
        out, path, count, size = None, "", 0, 0

        def done() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "records": [count], "bytes": [size]})

        for part in parts:
            for page_id, url, payload, _, digest, refers_to in zip(*[c for c in part.columns]):
                raw = record(page_id.as_py(), url.as_py(), payload.as_py(), digest.as_py(), refers_to.as_py(), date)
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = packer.compress(raw) + packer.flush()
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, path, count, size = system.open_output_stream(f"{inner}/{name}"), f"{folder}/{name}", 0, 0
                out.write(member)
                count, size = count + 1, size + len(member)
                if size >= ARCHIVE_BYTES:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    archives = described(pages, key, url, payload).mapInArrow(run, "path string, records bigint, bytes bigint")
    return settled(archives, "warc-archives")


class Members:
    """The decompressed bytes of a stream of gzip members, one member after the other."""

    def __init__(self, stream):
        self.stream, self.rest, self.at = stream, b"", 0
        self.unpack = None

    def open(self) -> bool:
        """Go to the next member; False at the end of the stream."""
        if not self.rest:
            self.rest = self.stream.read(STEP)
        self.unpack = zlib.decompressobj(31) if self.rest else None
        self.begin = self.at
        return self.unpack is not None

    def more(self) -> bytes:
        """Some bytes of this member, none at its end."""
        while not self.unpack.eof:
            if not self.rest:
                self.rest = self.stream.read(STEP)
                if not self.rest:
                    raise BadRecord("the archive ends inside a member")
            before = len(self.rest)
            try:
                data = self.unpack.decompress(self.rest, STEP)
            except zlib.error as error:
                raise BadRecord(f"not a gzip member: {error}") from error
            self.rest = self.unpack.unused_data if self.unpack.eof else self.unpack.unconsumed_tail
            self.at += before - len(self.rest)
            if data:
                return data
        return b""


def headers(lines: bytes) -> tuple[bytes, dict[str, str]]:
    """The first line, and the fields by lower-case name."""
    first, *rest = lines.split(b"\r\n")
    fields = {}
    for line in rest:
        name, colon, value = line.partition(b":")
        if not colon:
            raise BadRecord(f"a header without a colon: {line[:60]!r}")
        fields[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    return first, fields


def read_records(stream, keep_payload: bool = False) -> Iterator[dict]:
    """The records of an archive in order, each verified."""
    members = Members(stream)
    while members.open():
        try:
            yield _read_record(members, keep_payload)
        except (BadRecord, KeyError, ValueError) as error:
            raise BadRecord(f"record at byte {members.begin}: {error}") from error


def _read_record(members: Members, keep_payload: bool) -> dict:
    held = b""
    while (end := held.find(b"\r\n\r\n")) < 0:
        more = members.more()
        if not more:
            raise BadRecord("a member without the end of its header")
        held += more
    version, fields = headers(held[:end])
    if not version.startswith(b"WARC/1."):
        raise BadRecord(f"not a record: {version[:20]!r}")
    held, left = held[end + 4 :], int(fields["content-length"])
    block, payload, http, kept, size = hashlib.sha1(), hashlib.sha1(), b"", [], 0
    in_http = fields.get("content-type", "").startswith("application/http")
    while left:
        if not held:
            held = members.more()
            if not held:
                raise BadRecord("a block shorter than its Content-Length")
        part, held = held[:left], held[left:]
        left -= len(part)
        block.update(part)
        if in_http:
            http += part
            end = http.find(b"\r\n\r\n")
            if end < 0:
                continue
            part, http, in_http = http[end + 4 :], http[:end], False
        payload.update(part)
        size += len(part)
        if keep_payload:
            kept.append(part)
    while more := members.more():
        held += more
    if held != b"\r\n\r\n":
        raise BadRecord("a block longer than its Content-Length")
    if _b32(block.digest()).decode() != fields["warc-block-digest"]:
        raise BadRecord("the block does not match its digest")
    kind = fields["warc-type"]
    if kind == "response" and _b32(payload.digest()).decode() != fields["warc-payload-digest"]:
        raise BadRecord("the payload does not match its digest")
    if http:
        told = int(headers(http)[1].get("content-length", size))
        if kind == "response" and told != size:
            raise BadRecord("the payload is not as long as its HTTP header says")
        size = told
    return {
        "page_id": _page(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "record_type": kind,
        "payload_bytes": size, "payload_digest": base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex(),
        "refers_to": _page(fields.get("warc-refers-to", "")), "payload": b"".join(kept) if keep_payload and kind == "response" else None,
    }


def _page(name: str) -> int | None:
    name = name.strip("<>")
    return int(name.removeprefix("urn:page:")) if name.startswith("urn:page:") else None


def read(archives: DataFrame, keep_payload: bool = False) -> DataFrame:
    """One row per record of the archives; with `keep_payload` also the payload of responses."""
    schema = RECORDS + (", payload binary" if keep_payload else "")
    names = [f.strip().split()[0] for f in schema.split(",")]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for path in part.column(0):
                system, inner = file_system(path.as_py())
                with system.open_input_stream(inner) as stream:
                    yield from _batches(path.as_py(), read_records(stream, keep_payload), names)

    # An archive is some megabytes whatever the size of its row in the table, so each is a task of its own.
    tasks = min(max(1, archives.count()), MOST_TASKS)
    return archives.select("path").repartition(tasks).mapInArrow(run, schema)


def _batches(path: str, records: Iterator[dict], names: list[str]) -> Iterator[pa.RecordBatch]:
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}
    rows: list[dict] = []
    held = 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in names], names)

    try:
        for r in records:
            rows.append(r)
            held += len(r["payload"] or b"")
            if len(rows) == 10_000 or held > 32 << 20:
                yield batch()
                rows, held = [], 0
    except BadRecord as error:
        raise BadRecord(f"{path}: {error}") from error
    if rows:
        yield batch()
