"""WARC archives through a table of payload chunks.

Payloads travel as rows of (record, chunk number, data), each with the digest of the
payload so far, so that neither the writer nor the reader holds a whole archive, and
the reader no whole payload. Equal payloads of at least `revisit_bytes` bytes are
stored once, under the record with the largest page_id; the others are revisits.

Defined cases: a null payload is empty; a null page_id stays null and never refers to
or is preferred over another (it is the response only where all of its copies are
null); rows that tie for the largest page_id are all responses; a null url is left
out; white space in a url is percent-encoded; an empty table gives no archive; other
columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import files, storage

CHUNK_BYTES = 1 << 18
#: Bytes of an archive that are read at once.
READ_BYTES = 1 << 20
#: Bytes of chunk data in one Arrow batch, about.
BATCH_BYTES = 1 << 22

_CHUNK = "page_id long, url string, record_type string, refers_to long, payload_bytes long, chunk long, data binary, digest string, last boolean"
_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("chunk", pa.int64()), ("data", pa.binary()), ("digest", pa.string()), ("last", pa.bool_())])


def classify(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", revisit_bytes: int = 1000) -> DataFrame:
    """Add to each page its record type and, for revisits, the page referred to."""
    d = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(payload), F.lit("")).cast("binary").alias("payload"))
    d = d.withColumn("key", F.unhex(F.sha2("payload", 256)))
    groups = d.where(F.octet_length("payload") >= revisit_bytes).groupBy("key").agg(F.count("*").alias("n"), F.max("page_id").alias("response_id"))
    groups = storage.table(groups.where("n > 1").drop("n"), "payloads")
    again = F.col("response_id").isNotNull() & ~F.col("response_id").eqNullSafe(F.col("page_id"))
    return d.join(groups, "key", "left").select("page_id", "url", "payload", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("response_id")).alias("refers_to"))


class _Out:
    """Chunk rows, given out as batches of bounded size."""

    def __init__(self):
        self.rows, self.bytes = [], 0

    def add(self, *row) -> bool:
        self.rows.append(row)
        self.bytes += len(row[6]) + 200
        return self.bytes >= BATCH_BYTES

    def batch(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*self.rows, strict=True), _SCHEMA.types, strict=True)], schema=_SCHEMA)
        self.rows, self.bytes = [], 0
        return out


def chunks(records: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunk table: a record's chunks lie together in order, an empty payload has one."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out()
        for batch in batches:
            ids, urls, payloads, types, refers = (batch.column(i) for i in range(5))
            for i in range(len(batch)):
                whole, sha = memoryview(payloads[i].as_buffer()), hashlib.sha1()
                for k, at in enumerate(range(0, max(1, len(whole)), chunk_bytes)):
                    part = whole[at : at + chunk_bytes]
                    sha.update(part)
                    if out.add(ids[i].as_py(), urls[i].as_py(), types[i].as_py(), refers[i].as_py(), len(whole), k, bytes(part), sha.hexdigest(), at + chunk_bytes >= len(whole)):
                        yield out.batch()
        if out.rows:
            yield out.batch()

    return records.select("page_id", "url", "payload", "record_type", "refers_to").mapInArrow(cut, _CHUNK)


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _heads(row: dict, digest: str, date: str) -> bytes:
    """WARC and HTTP headers of a record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n"
    revisit = row["record_type"] == "revisit"
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {record_id(row['page_id'])}", f"WARC-Date: {date}"]
    if row["page_id"] is not None:
        lines.append(f"X-Page-ID: {row['page_id']}")
    if row["url"] is not None:
        lines.append("WARC-Target-URI: " + quote(row["url"], safe="!#$&'()*+,/:;=?@[]~-._"))
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(row['refers_to'])}", f"X-Refers-To-Page: {row['refers_to']}"]
    lines += ["WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(), "Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + (0 if revisit else row['payload_bytes'])}"]
    return ("\r\n".join(lines) + "\r\n\r\n" + http).encode()


def write(table: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write a chunk table as archives, one gzip member a record; returns the manifest.

    A header stands before its payload, so a record of several chunks waits in a
    spooled file until its digest is known; one chunk at a time is in memory.
    """
    spark = table.sparkSession
    folder = storage.new_folder(spark, "warc")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tempfile

        from pyspark import TaskContext

        out, path, n = None, "", 0
        body = spool = None
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path = files.attempt(folder, f"part-{TaskContext.get().partitionId():07d}") + ".warc.gz"
                    out = files.create(path)
                if row["chunk"] == 0:
                    body, spool = [], None
                if row["record_type"] != "revisit":
                    if row["last"] and spool is None:
                        body.append(row["data"])
                    else:
                        spool = spool or tempfile.SpooledTemporaryFile(max_size=4 * CHUNK_BYTES)
                        spool.write(row["data"])
                if row["last"]:
                    member = zlib.compressobj(3, zlib.DEFLATED, 31)
                    out.write(member.compress(_heads(row, row["digest"], date)))
                    if spool is not None:
                        spool.seek(0)
                        while part := spool.read(CHUNK_BYTES):
                            out.write(member.compress(part))
                        spool.close()
                    for part in body:
                        out.write(member.compress(part))
                    out.write(member.compress(b"\r\n\r\n") + member.flush())
                    n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "n_records": [n]})

    return storage.table(table.mapInArrow(put, "path string, n_records long"), "manifest")


class _Members:
    """The bytes of a file of gzip members, decompressed as they are asked for."""

    def __init__(self, stream):
        self.stream, self.rest, self.held = stream, b"", bytearray()
        self.inflate = zlib.decompressobj(31)

    def more(self) -> bool:
        if self.inflate.eof:
            self.rest, self.inflate = self.inflate.unused_data, zlib.decompressobj(31)
        data = self.rest or self.inflate.unconsumed_tail or self.stream.read(READ_BYTES)
        self.rest = b""
        if not data:
            return False
        self.held += self.inflate.decompress(data, READ_BYTES)
        return True

    def until(self, mark: bytes) -> bytes:
        seen = 0
        while (at := self.held.find(mark, seen)) < 0:
            seen = max(0, len(self.held) - len(mark))
            if not self.more():
                if self.held:
                    raise ValueError("an archive ends inside a record")
                return b""
        out = bytes(self.held[: at + len(mark)])
        del self.held[: at + len(mark)]
        return out

    def take(self, most: int) -> bytes:
        while not self.held:
            if not self.more():
                raise ValueError("an archive ends inside a payload")
        out = bytes(self.held[:most])
        del self.held[: len(out)]
        return out


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if line)


def read(manifest: DataFrame, with_data: bool = True) -> DataFrame:
    """The chunk table of archives; payload_bytes and, on the last chunk, digest are of the full payload.

    The digests of what was read must equal those in the headers.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out()
        for batch in batches:
            for path in batch.column(0).to_pylist():
                source = _Members(files.open_stream(path))
                while head := source.until(b"\r\n\r\n"):
                    fields = _fields(head)
                    http = source.until(b"\r\n\r\n")
                    total, left = int(_fields(http)["Content-Length"]), int(fields["Content-Length"]) - len(http)
                    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    page, refers = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page")
                    who = (page and int(page), "WARC-Target-URI" in fields and unquote(fields["WARC-Target-URI"]) or fields.get("WARC-Target-URI"), fields["WARC-Type"], refers and int(refers), total)
                    k, sha, held = 0, hashlib.sha1(), fields["WARC-Type"] != "revisit"
                    while left or not k:
                        part = source.take(min(left, CHUNK_BYTES)) if left else b""
                        left -= len(part)
                        sha.update(part)
                        if not left and held and sha.hexdigest() != digest:
                            raise ValueError(f"{path}: the payload of page {page} does not have its digest")
                        if out.add(*who, k, part if with_data else b"", sha.hexdigest() if held else digest, not left):
                            yield out.batch()
                        k += 1
                    if source.until(b"\r\n\r\n") != b"\r\n\r\n":
                        raise ValueError(f"{path}: a record does not end where it should")
        if out.rows:
            yield out.batch()

    n = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return manifest.select("path").repartition(n).mapInArrow(parse, _CHUNK)
