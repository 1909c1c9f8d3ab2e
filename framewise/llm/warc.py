"""WARC archives: write, normalise a monolithic gzip, read by offset.

``write_archives`` puts one record per page into archives that are one gzip
stream each, as many tools leave them.  ``normalise`` inflates each such file
once as a stream, rewrites every record as a gzip member of its own and puts
an offset index beside the file (``.idx``: offset, length, record id), which
makes records readable one by one.  ``read_archives`` seeks to the offsets.

Payloads are compared by SHA-1 and length; of equal ones the page with the
smallest id is the response and the others revisit it, with headers that name
the digest and length of the full payload.  Only groups with several pages
are joined back, by a broadcast if they are few (counted) and by a shuffle
join otherwise, whose large groups Spark splits.

Files are written below ``root`` with Arrow's file systems (local or mounted
folders, HDFS, object stores); a task names its files by a random id and the
manifest table, committed by Spark, lists those of the tasks that succeeded,
so retried tasks leave no doubt.  A task holds one record at a time.

Defined results.  Null html: an empty payload.  Null id: an empty id, read
back as null; such rows are responses unless a page with an id has the
payload.  Rows that repeat the smallest id of their payload are all responses.
Null url: no target header; line breaks in urls are percent-encoded.  Empty
table: no files, empty result.  Other columns are not carried.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewise.llm.common import bounded_batches, flat, maybe_broadcast, write_scratch
from framewise.session import scratch_path

#: Bytes of records after which a task begins its next archive.
ARCHIVE_BYTES = 64 << 20
CHUNK = 1 << 20
#: Rows of about 40 bytes up to which the groups of equal payloads are broadcast (40 MB).
BROADCAST_ROWS = 1_000_000
_GZIP = 31


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def _record(page_id, url, sha: str, size: int, refers_to, payload: bytes | None) -> bytes:
    """One WARC record; ``payload`` is None for a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if payload is not None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha)).decode()}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if payload is None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
    block = http + (payload or b"")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _write(batches, root: str, level: int):
    place, base = _place(root)
    place.create_dir(base, recursive=True)
    sink = path = pack = None
    size = records = 0
    done: list[tuple[str, int]] = []

    def close():
        sink.write(pack.flush())
        sink.close()
        done.append((path, records))

    for batch in batches:
        columns = [flat(batch, c).to_pylist() for c in ("page_id", "url", "html", "sha", "size", "refers_to")]
        for page_id, url, html, sha, n, refers_to in zip(*columns, strict=True):
            if sink is None:
                path = f"{base}/{uuid.uuid4().hex}.warc.gz"
                sink, pack, size, records = place.open_output_stream(path, compression=None), zlib.compressobj(level, wbits=_GZIP), 0, 0
            raw = _record(page_id, url, sha, n, refers_to, (html or "").encode() if refers_to is None else None)
            sink.write(pack.compress(raw))
            size += len(raw)
            records += 1
            if size >= ARCHIVE_BYTES:
                close()
                sink = None
    if sink is not None:
        close()
    yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()),
                                      pa.array([d[1] for d in done], pa.int64())], names=["path", "records"])


def marked(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, sha, size, refers_to): ``refers_to`` is null for
    the pages whose payload becomes a response."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumns({"sha": F.sha1("html"), "size": F.octet_length("html").cast("long")})
    again = write_scratch(rows.groupBy("sha", "size").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "payloads")
    joined = rows.join(maybe_broadcast(again, BROADCAST_ROWS), ["sha", "size"], "left")
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return joined.select("page_id", "url", "html", "sha", "size", refers_to.alias("refers_to"))


def write_archives(pages: DataFrame, root: str, level: int = 1) -> DataFrame:
    """Archives of ``pages`` (page_id, url, html) as monolithic gzip files
    below ``root``; the written manifest (path, records)."""
    bounded_batches(pages.sparkSession)
    manifest = marked(pages).mapInArrow(lambda it: _write(it, root, level), "path string, records long")
    return write_scratch(manifest, "warc-manifest")


class _Stream:
    """Bytes of an inflated file, read line by line or by number."""

    def __init__(self, source) -> None:
        self.source, self.inflate, self.held = source, zlib.decompressobj(_GZIP), b""

    def more(self) -> bool:
        while raw := self.inflate.unused_data or self.source.read(CHUNK):
            if self.inflate.eof:  # the next member of a file that has several
                self.inflate = zlib.decompressobj(_GZIP)
            out = self.inflate.decompress(raw)
            if out:
                self.held += out
                return True
        return False

    def until(self, mark: bytes) -> bytes:
        seen = 0
        while (at := self.held.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.held)
            if not self.more():
                if self.held.strip():
                    raise ValueError("cut-off WARC header")
                return b""
        out, self.held = self.held[:at + len(mark)], self.held[at + len(mark):]
        return out

    def take(self, n: int) -> bytes:
        parts, have = [self.held], len(self.held)
        while have < n:
            self.held = b""
            if not self.more():
                raise ValueError("cut-off WARC record")
            parts.append(self.held)
            have += len(self.held)
        whole = b"".join(parts)
        self.held = whole[n:]
        return whole[:n]


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n") if ": " in line)


def records_of(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, whole record) of an archive, however it is cut into
    gzip members, from one pass over the stream."""
    stream = _Stream(source)
    while head := stream.until(b"\r\n\r\n"):
        fields = _fields(head)
        body = stream.take(int(fields["Content-Length"]) + 4)
        yield fields, head.lstrip() + body


def _normalise(batches, root: str, level: int):
    place, base = _place(root)
    place.create_dir(base, recursive=True)
    for batch in batches:
        for path in flat(batch, "path").to_pylist():
            out, at, rows = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, []
            with place.open_input_stream(path, compression=None) as source, \
                    place.open_output_stream(out, compression=None) as sink, \
                    place.open_output_stream(out + ".idx", compression=None) as index:
                for fields, record in records_of(source):
                    pack = zlib.compressobj(level, wbits=_GZIP)
                    member = pack.compress(record) + pack.flush()
                    sink.write(member)
                    index.write(f"{at}\t{len(member)}\t{fields['WARC-Record-ID']}\n".encode())
                    rows.append((at, len(member), fields["WARC-Record-ID"]))
                    at += len(member)
            yield pa.RecordBatch.from_arrays(
                [pa.array([out] * len(rows), pa.string()),
                 *(pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string())))],
                names=["path", "offset", "length", "record_id"])


def normalise(spark: SparkSession, manifest: DataFrame, root: str, level: int = 6) -> DataFrame:
    """Rewrite the archives that ``manifest`` names, a record a member; the
    written index (path, offset, length, record_id)."""
    files = manifest.select("path").repartition(max(1, manifest.count()))
    return write_scratch(files.mapInArrow(
        lambda it: _normalise(it, root, level),
        "path string, offset long, length long, record_id string"), "warc-index")


_READ = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
         "refers_to long, url string")


def _id(urn: str | None):
    number = (urn or "")[len("<urn:page:"):-1]
    return int(number) if number else None


def _read(batches, root: str):
    place, path, source = _place(root)[0], None, None
    for batch in batches:
        rows = []
        for name, offset, length in zip(*(flat(batch, c).to_pylist() for c in ("path", "offset", "length")), strict=True):
            if name != path:
                if source:
                    source.close()
                path, source = name, place.open_input_file(name)
            source.seek(offset)
            raw = zlib.decompress(source.read(length), _GZIP)
            head, block = raw.split(b"\r\n\r\n", 1)
            fields = _fields(head)
            http, payload = block[:int(fields["Content-Length"])].split(b"\r\n\r\n", 1)
            size, digest = int(_fields(http)["Content-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
            if fields["WARC-Type"] == "response" and (
                    size != len(payload) or digest != base64.b32encode(hashlib.sha1(payload).digest()).decode()):
                raise ValueError(f"{path} at {offset}: the payload does not match its digest")
            rows.append((_id(fields["WARC-Record-ID"]), size, digest, fields["WARC-Type"],
                         _id(fields.get("WARC-Refers-To")), fields.get("WARC-Target-URI")))
        types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)],
            names=[c.split()[0] for c in _READ.split(", ")])
    if source:
        source.close()


def read_archives(index: DataFrame, root: str) -> DataFrame:
    """The records that ``index`` names, each read at its offset and checked
    against its digest."""
    return index.sortWithinPartitions("path", "offset").mapInArrow(lambda it: _read(it, root), _READ)


def archive_round_trip(pages: DataFrame, root: str | None = None) -> DataFrame:
    """Write, normalise and read back ``pages``."""
    spark = pages.sparkSession
    root = root or scratch_path(spark, "warc")
    manifest = write_archives(pages, root)
    index = normalise(spark, manifest, f"{root}/members")
    return read_archives(index, f"{root}/members")
