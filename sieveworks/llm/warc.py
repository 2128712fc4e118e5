"""WARC archives as a table of chunks: written and read in pieces of bounded size."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import read_table, shared_path, stored

#: Payload bytes in a chunk row, bytes read or written at once, bytes after which a task begins another archive, and the gzip level.
CHUNK, PIECE, ARCHIVE, LEVEL = 1 << 20, 1 << 18, 1 << 29, 3

#: Fixed values of the WARC format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CHUNK_SCHEMA = "archive string, record_no long, record_id string, record_type string, target_uri string, refers_to string, declared_digest string, declared_bytes long, chunk_no int, data binary, bytes_so_far long, digest_so_far string, last boolean"
_CHUNK_TYPES = pa.schema([("archive", pa.string()), ("record_no", pa.int64()), *((n, pa.string()) for n in ("record_id", "record_type", "target_uri", "refers_to", "declared_digest")), ("declared_bytes", pa.int64()), ("chunk_no", pa.int32()), ("data", pa.binary()), ("bytes_so_far", pa.int64()), ("digest_so_far", pa.string()), ("last", pa.bool_())])


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _payload(column: str) -> Column:
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def revisits(pages: DataFrame, *, page_id: str = "page_id", html: str = "html", least_bytes: int = 1000) -> DataFrame:
    """(page_id, digest, refers_to) of the pages whose payload a page with a larger id holds too.

    Only digests are shuffled, and they are pre-aggregated in the map tasks.
    """
    base = pages.select(F.col(page_id).cast("long").alias("page_id"), F.sha1(_payload(html)).alias("digest"), F.octet_length(_payload(html)).alias("n")).where(F.col("n") >= least_bytes)
    top = base.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("copies")).where("copies > 1 and refers_to is not null").select("digest", "refers_to")
    return base.select("page_id", "digest").join(top, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).distinct()


def chunk_rows(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", chunk: int = CHUNK) -> DataFrame:
    """(page_id, url, digest, n_bytes, row, chunk_no, data): every payload in pieces of at most chunk bytes, an empty one as one empty piece."""
    whole = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), _payload(html).alias("payload"), F.monotonically_increasing_id().alias("row"))
    whole = whole.withColumns({"digest": F.sha1("payload"), "n_bytes": F.octet_length("payload").cast("long")})
    pieces = F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.col("n_bytes") - 1, F.lit(0)) / chunk).cast("int")), lambda k: F.substring(F.col("payload"), k * chunk + 1, F.lit(chunk)))
    return whole.select("page_id", "url", "digest", "n_bytes", "row", F.posexplode(pieces).alias("chunk_no", "data"))


def _headers(kind: str, fields: list[tuple[str, str | None]], length: int) -> bytes:
    lines = [VERSION.decode(), f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {length}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def _uri(url: str | None) -> str | None:
    return None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


class ArchiveWriter:
    """One gzip member for each record; a record is opened with its length and then fed in pieces."""

    def __init__(self, uri: str, date: str):
        filesystem, path = _filesystem(uri)
        filesystem.create_dir(path.rpartition("/")[0], recursive=True)
        self.uri, self.date, self.out, self.size, self.records = uri, date, filesystem.open_output_stream(path, compression=None), 0, 0
        body = b"format: WARC File Format 1.1\r\n"
        self.begin(_headers("warcinfo", [("WARC-Record-ID", f"<urn:archive:{uri.rpartition('/')[2]}>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")], len(body)) + body)
        self.end()
        self.records = 0

    def begin(self, head: bytes) -> None:
        self.gzip = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        self.feed(head)

    def feed(self, data) -> None:
        view = memoryview(data)
        for i in range(0, len(view), PIECE):
            self._put(self.gzip.compress(view[i : i + PIECE]))

    def end(self) -> None:
        self._put(self.gzip.compress(b"\r\n\r\n") + self.gzip.flush())
        self.records += 1

    def page(self, page_id: int | None, url: str | None, digest: str, n_bytes: int, refers_to: int | None) -> bool:
        """Opens a record; whether its payload is to follow."""
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
        fields = [("WARC-Record-ID", _record_id(page_id)), ("WARC-Date", self.date), ("WARC-Target-URI", _uri(url)), ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()), ("Content-Type", "application/http; msgtype=response")]
        if refers_to is None:
            self.begin(_headers("response", fields, len(http) + n_bytes) + http)
            return True
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _record_id(refers_to))]
        self.begin(_headers("revisit", fields, len(http)) + http)
        return False

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        return self.uri, self.records, self.size

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def write_archives(pages: DataFrame, folder: str, *, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 1000, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes the archives below folder, a URI that all executors reach; returns (archive, records, bytes).

    A record is written piece by piece from chunk rows.  Names hold the task
    attempt, and only archives of attempts that succeeded are in the result,
    which is itself stored: a lost executor leaves at most an unlisted file.
    """
    chunks = chunk_rows(pages, page_id=page_id, url=url, html=html)
    again = revisits(pages, page_id=page_id, html=html, least_bytes=least_bytes).select(F.col("page_id").alias("p"), F.col("digest").alias("g"), "refers_to")
    rows = chunks.join(again, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("digest") == F.col("g")), "left")
    rows = rows.select("page_id", "url", "digest", "n_bytes", "row", "chunk_no", F.when(F.col("refers_to").isNull(), F.col("data")).alias("data"), "refers_to").where("refers_to is null or chunk_no = 0")
    rows = rows.sortWithinPartitions("page_id", "digest", "row", "chunk_no")
    folder = folder.rstrip("/")

    def write(batches):
        task, writer, done, takes = TaskContext.get(), None, [], False
        for batch in batches:
            for page, url, digest, n, _, chunk_no, data, refers_to in zip(*(c if c.type == pa.binary() else c.to_pylist() for c in batch.columns), strict=True):
                if not chunk_no:
                    if writer is not None:
                        writer.end()
                        if writer.size >= ARCHIVE:
                            done.append(writer.close())
                            writer = None
                    if writer is None:
                        writer = ArchiveWriter(f"{folder}/pages-{task.partitionId():06d}-{len(done):04d}-{task.taskAttemptId()}.warc.gz", date)
                    takes = writer.page(page, url, digest, n, refers_to)
                if takes:
                    writer.feed(data.as_buffer())
        if writer is not None:
            writer.end()
            done.append(writer.close())
        cols = list(zip(*done, strict=True)) if done else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())], names=["archive", "records", "bytes"])

    return stored(rows.mapInArrow(write, "archive string, records long, bytes long"), "archives")


class Inflated:
    """The decompressed bytes of an archive, held in a buffer of bounded size."""

    def __init__(self, raw):
        self.raw, self.gzip, self.buffer, self.rest = raw, zlib.decompressobj(31), bytearray(), b""

    def fill(self) -> bool:
        while True:
            data = self.rest or self.raw.read(PIECE)
            self.rest = b""
            if not data:
                return False
            if self.gzip.eof:
                self.gzip = zlib.decompressobj(31)
            out = self.gzip.decompress(data, PIECE)
            self.rest = self.gzip.unconsumed_tail or self.gzip.unused_data
            if out:
                self.buffer += out
                return True

    def line(self) -> bytes | None:
        at = 0
        while (end := self.buffer.find(b"\n", at)) < 0:
            at = len(self.buffer)
            if not self.fill():
                return None
        got = bytes(self.buffer[: end + 1])
        del self.buffer[: end + 1]
        return got

    def take(self, n: int) -> bytes:
        """At most n bytes; fewer only at the end."""
        while len(self.buffer) < n and self.fill():
            pass
        got = bytes(self.buffer[:n])
        del self.buffer[:n]
        return got


def read_records(stream: Inflated, archive: str, chunk: int, with_data: bool) -> Iterator[tuple]:
    """Chunk rows of the response and revisit records, in order; see read_archives()."""
    number = 0
    while (line := stream.line()) is not None:
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{archive}: no record begins at {line[:40]!r}")
        head = {}
        while (line := stream.line()) is not None and line.strip():
            k, _, v = line.decode("utf-8", "replace").partition(":")
            head[k.strip().lower()] = v.strip()
        left, kind = int(head["content-length"]), head.get("warc-type")
        length = None
        if kind in ("response", "revisit") and head.get("content-type", "").startswith("application/http"):
            while left and (line := stream.line()) is not None:
                left -= len(line)
                if not line.strip():
                    break
                k, _, v = line.decode("latin-1").partition(":")
                if k.strip().lower() == "content-length":
                    length = int(v)
        sha, total, no = hashlib.sha1(), 0, 0
        digest = head.get("warc-payload-digest")
        if digest is not None:
            digest = digest.rpartition(":")[2]
            digest = base64.b32decode(digest).hex() if len(digest) == 32 else digest.lower()
        same = (archive, number, head.get("warc-record-id"), kind, head.get("warc-target-uri"), head.get("warc-refers-to"), digest, length)
        number += 1
        while True:
            data = stream.take(min(left, chunk))
            if len(data) < min(left, chunk):
                raise ValueError(f"{archive}: it ends within a record")
            left -= len(data)
            if kind not in ("response", "revisit"):
                if not left:
                    break
                continue
            sha.update(data)
            total += len(data)
            yield (*same, no, data if with_data else None, total, sha.hexdigest(), not left)
            no += 1
            if not left:
                break


def read_archives(archives: DataFrame, *, chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """The chunk table of the archives named in column archive, each read as a stream.

    A row holds at most chunk payload bytes of a record (HTTP headers are taken
    off), its number in the record, and the bytes and the SHA-1 of the payload
    up to its end; in the row with last set they are those of the whole payload.
    declared_digest and declared_bytes are what the headers say, for revisits of
    the payload that they refer to.
    """
    n = max(1, min(archives.count(), 10_000))

    def read(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                filesystem, path = _filesystem(uri)
                rows, held = [], 0
                with filesystem.open_input_stream(path, compression=None) as raw:
                    for row in read_records(Inflated(raw), uri, chunk, with_data):
                        rows.append(row)
                        held += len(row[9] or b"") + 200
                        if held >= 8 * CHUNK:
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)

    return archives.select("archive").repartition(n).mapInArrow(read, CHUNK_SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _CHUNK_TYPES, strict=True)], schema=_CHUNK_TYPES)


def round_trip(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 1000) -> DataFrame:
    """Writes a record for each page and reads the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to, intact.

    Null payloads are empty, null urls are left out of the headers.  Of equal
    payloads of at least least_bytes bytes the record with the largest page_id
    is the response (several rows with that page_id all are), the others revisit
    it; null page_ids count as the smallest, and among such rows only, all are
    responses.  intact: the payload read matches the declared digest.
    Repeated rows have a record each; other columns, whatever their names, are
    ignored; an empty table gives no rows.  A payload of any size is written and
    read in pieces; only the row of the page itself is in memory whole.
    """
    archives = write_archives(pages, shared_path(pages.sparkSession, "warc"), page_id=page_id, url=url, html=html, least_bytes=least_bytes)
    ends = read_archives(archives, with_data=False).where("last")
    revisit = F.col("record_type") == "revisit"
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1)
    return ends.select(
        F.nullif(number("record_id"), F.lit("")).cast("long").alias("page_id"),
        F.when(revisit, F.col("declared_bytes")).otherwise(F.col("bytes_so_far")).alias("payload_bytes"),
        F.when(revisit, F.col("declared_digest")).otherwise(F.col("digest_so_far")).alias("payload_digest"),
        "record_type",
        F.when(revisit, F.nullif(number("refers_to"), F.lit("")).cast("long")).alias("refers_to"),
        (revisit | (F.col("declared_digest") == F.col("digest_so_far"))).alias("intact"),
    )


def op7_warc_chunks(spark, sf_dir: str) -> DataFrame:
    """Every page through WARC archives and back."""
    return round_trip(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


#: Of equal payloads, the row with the largest page_id is the response.
OP7_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(encode(coalesce(html, ''))) AS payload_digest FROM pages
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM p
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to,
  TRUE AS intact
FROM g
"""
