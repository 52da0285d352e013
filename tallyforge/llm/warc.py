"""WARC archives written and read as streams of chunks.

A page is a record; what the archives hold travels as rows of a chunked record table: record identifier, chunk number
and at most ``CHUNK`` bytes. The payload of a large page is cut into chunks before it leaves the JVM, the writer
appends chunk after chunk to a compressed file, and the reader gives chunks out again with the digest of the payload so
far, so neither ever holds a whole record. Of equal large payloads one is stored; the others are revisit records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import Any
from urllib.parse import quote

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.frames import stored
from tallyforge.session import shared_root

#: Bytes of payload in a row.
CHUNK = 1 << 20
#: Payloads of at least this many bytes are stored once.
REVISIT_BYTES = 1000
#: A file is closed at a record's end beyond this many compressed bytes, and a task goes on with the next.
FILE_BYTES = 1 << 30
#: Tables of repeated digests up to this many rows (about 100 MB) are broadcast.
BROADCAST_ROWS = 1_000_000
# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def record_table(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = REVISIT_BYTES) -> DataFrame:
    """Chunk rows ``key, url, record_type, refers_to, payload_bytes, payload_digest, chunk, data`` of all pages, each record's together.

    A null or empty page has an empty payload. Among equal payloads of at least ``least`` bytes the largest key is the
    response; rows that repeat that key are responses too, and a row without a key is always one.
    """
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload"))
    sized = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", F.sha1("payload"))
    large = sized.where((F.col("payload_bytes") >= least) & F.col("key").isNotNull())
    groups = large.groupBy("payload_digest").agg(F.max("key").alias("response"), F.count("*").alias("n")).where("n > 1").select("payload_digest", "response")
    groups = stored(groups, "payloads")
    known = sized.join(F.broadcast(groups) if groups.count() <= BROADCAST_ROWS else groups, "payload_digest", "left")
    typed = known.withColumn("refers_to", F.when((F.col("payload_bytes") >= least) & (F.col("key") < F.col("response")), F.col("response")))
    revisit = F.col("refers_to").isNotNull()
    last = F.when(revisit | (F.col("payload_bytes") == 0), 0).otherwise(F.floor((F.col("payload_bytes") - 1) / CHUNK)).cast("int")
    cut = typed.select("*", F.explode(F.sequence(F.lit(0), last)).alias("chunk"))
    data = F.when(revisit, F.lit(b"")).otherwise(F.substring("payload", F.col("chunk") * CHUNK + 1, F.lit(CHUNK)))
    kind = F.when(revisit, "revisit").otherwise("response")
    return cut.select("key", "url", kind.alias("record_type"), "refers_to", "payload_bytes", "payload_digest", "chunk", data.alias("data"))


def _record_id(key: Any) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'page:{key}'.encode()).digest())}>"


def _head(key: Any, url: str | None, kind: str, refers: Any, n: int, digest: str) -> bytes:
    """The header lines of a record and of the reply inside it; the payload follows."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {_record_id(key)}",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"X-Page-Id: {'' if key is None else key}",
        f"X-Payload-Length: {n}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~-._' + chr(39))}")
    if refers is not None:
        lines += [f"WARC-Refers-To: {_record_id(refers)}", f"X-Refers-To-Page: {refers}", f"WARC-Profile: {PROFILE}"]
    lines.append(f"Content-Length: {len(http) + (0 if kind == 'revisit' else n)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


class _Archive:
    """A file of compressed records, written chunk by chunk."""

    def __init__(self, folder: str) -> None:
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.gz"  # a repeated task writes another file; only finished tasks are listed
        files, name = FileSystem.from_uri(self.path)
        self.out, self.records, self.bytes, self.zip = files.open_output_stream(name, compression=None), 0, 0, None

    def begin(self, head: bytes) -> None:
        self.zip = zlib.compressobj(1, zlib.DEFLATED, 31)  # every record is a gzip member of its own
        self.add(head)

    def add(self, data: bytes) -> None:
        self._put(self.zip.compress(data))

    def end(self) -> None:
        self.add(b"\r\n\r\n")
        self._put(self.zip.flush())
        self.records += 1

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)


def write_archives(chunks: DataFrame, folder: str) -> DataFrame:
    """Writes chunk rows to archives under ``folder``, a shared folder, and returns ``(path, records, bytes)`` of each.

    The list is written before it is returned: every file in it is whole and belongs to a task that ended well.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, open_record = None, False
        done: list[tuple] = []

        def close() -> None:
            archive.out.close()
            done.append((archive.path, archive.records, archive.bytes))

        for batch in batches:
            for key, url, kind, refers, n, digest, chunk, data in zip(*batch.columns, strict=True):
                if chunk.as_py() == 0:
                    if open_record:
                        archive.end()
                    if archive is not None and archive.bytes >= FILE_BYTES:
                        close()
                        archive = None
                    archive = archive or _Archive(folder)
                    archive.begin(_head(key.as_py(), url.as_py(), kind.as_py(), refers.as_py(), n.as_py(), digest.as_py()))
                    open_record = True
                archive.add(data.as_buffer() if data.is_valid else b"")
        if open_record:
            archive.end()
        if archive is not None:
            close()
        columns = list(zip(*done, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], ["path", "records", "bytes"])

    return stored(chunks.mapInArrow(write, "path string, records long, bytes long"), "archives")


def new_folder(spark: SparkSession) -> str:
    """A new folder for archives below the shared one."""
    root = shared_root(spark)
    path = f"{root if '://' in root else 'file://' + root}/tallyforge-llm/warc-{uuid.uuid4().hex}"
    files, name = FileSystem.from_uri(path)
    files.create_dir(name, recursive=True)
    return path


def _headers(stream: gzip.GzipFile) -> dict[str, str] | None:
    """The header lines of the next record; None at the end of the file."""
    line = stream.readline()
    while line == b"\r\n":
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a record: {line[:40]!r}")
    found = {}
    while (line := stream.readline()) not in (b"\r\n", b""):
        name, _, value = line.decode().partition(":")
        found[name.lower()] = value.strip()
    return found


def read_archives(archives: DataFrame, key_type: str = "long", with_data: bool = True) -> DataFrame:
    """Chunk rows of all records: ``key, uri, record_type, refers_to, chunk, last, payload_bytes, payload_digest, data``.

    Bytes and digest are those of the payload up to the end of the chunk, so a record's row with ``last`` has those of all of
    it. For a revisit they are those of the payload it stands for. Without ``with_data`` the chunks are read and digested
    all the same, but left out, and only the last row of each record is given. A payload that does not have the digest
    its header names is an error.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, name = FileSystem.from_uri(path)
                with files.open_input_stream(name, compression=None, buffer_size=CHUNK) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    yield from _batches(_chunks(stream, with_data))

    schema = f"key {key_type}, uri string, record_type string, refers_to {key_type}, chunk int, last boolean, payload_bytes long, payload_digest string, data binary"
    n = max(1, archives.count())
    return archives.select("path").repartition(n, "path").mapInArrow(read, schema)


def _chunks(stream: gzip.GzipFile, with_data: bool) -> Iterator[tuple]:
    while (head := _headers(stream)) is not None:
        length, kind = int(head["content-length"]), head["warc-type"]
        while (line := stream.readline()) != b"\r\n":  # the reply's own header
            length -= len(line)
        length -= 2
        digest, told, read, chunk = hashlib.sha1(), base64.b32decode(head["warc-payload-digest"].partition(":")[2]).hex(), 0, 0
        key = int(head["x-page-id"]) if head["x-page-id"] else None
        refers = int(head["x-refers-to-page"]) if "x-refers-to-page" in head else None
        while True:
            data = stream.read(min(CHUNK, length - read))
            digest.update(data)
            read += len(data)
            last = read == length
            if not last and not data:
                raise ValueError("the archive is cut off")
            if kind == "revisit":
                yield key, head.get("warc-target-uri"), kind, refers, 0, True, int(head["x-payload-length"]), told, b""
            elif last and digest.hexdigest() != told:
                raise ValueError(f"record {head['warc-record-id']} does not have its digest")
            elif last or with_data:
                yield key, head.get("warc-target-uri"), kind, refers, chunk, last, read, digest.hexdigest(), data if with_data else None
            chunk += 1
            if last:
                break


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.binary()]
    names = ["key", "uri", "record_type", "refers_to", "chunk", "last", "payload_bytes", "payload_digest", "data"]
    held, n = [], 0
    for row in rows:
        held.append(row)
        n += len(row[-1] or b"") + 200
        if n >= 4 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), kinds, strict=True)], names)
            held, n = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), kinds, strict=True)], names)
