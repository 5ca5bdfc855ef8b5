"""WARC archives: pages to records, whole-file gzip streams to one member per record.

``write_streams`` puts the records of a task into gzip streams of about ``STREAM_BYTES``,
a file each. ``normalise`` inflates such a stream once, front to back, packs every record
as a gzip member of its own and writes a sidecar beside each archive with a line per record:
offset, length, type, id and digest. ``read_records`` reads archives member by
member and checks them against the sidecar and the payload digests.

Records with equal payloads of at least ``REVISIT_BYTES`` bytes share one
response, the one with the largest page id; the others are revisits that keep
the headers, the digest and a reference.

Defined cases: null html is an empty payload; a null url leaves the target out;
null page ids count as smallest (only nulls: all are responses). Repeated rows with the largest id are all
responses. Empty tables give archives without records. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections.abc import Iterable, Iterator

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.cells import read_cells, write_cells
from tickloom.llm.common import arrow_map

REVISIT_BYTES = 0
#: Bytes of a gzip stream at which the next one begins; a larger record has one alone.
STREAM_BYTES = 64 << 20
#: Bytes that are inflated or fed at a time.
CHUNK = 1 << 20
DATE = "2026-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP = 31  # zlib's window bits for a gzip wrapper


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(identifier: str) -> int | None:
    tail = identifier.strip("<>").rpartition(":")[2]
    return None if tail == "none" else int(tail)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def safe_uri(url: str) -> str:
    """A header value: blanks and control characters are percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def render(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record, uncompressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {safe_uri(url)}"] if url else []),
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
        *([f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record starts with {lines[0][:40]!r}")
    return {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in lines[1:] if x)}


def records(chunks: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, raw bytes) of each record of an uncompressed stream that comes in chunks."""
    held, chunks = bytearray(), iter(chunks)

    def more() -> bool:
        chunk = next(chunks, None)
        if chunk is not None:
            held.extend(chunk)
        return chunk is not None

    while True:
        while held[:2] == b"\r\n":  # stray blank lines between records
            del held[:2]
        looked = 0
        while (cut := held.find(b"\r\n\r\n", looked)) < 0:
            looked = max(0, len(held) - 3)
            if not more():
                if held.strip(b"\r\n\0"):
                    raise ValueError("the stream ends within a record's headers")
                return
        headers = headers_of(bytes(held[:cut]))
        end = cut + 4 + int(headers["content-length"])
        while len(held) < end + 4 and more():
            pass
        if len(held) < end:
            raise ValueError("the stream ends within a record")
        yield headers, bytes(held[:end]) + b"\r\n\r\n"
        del held[: end + 4]


def inflated(content: bytes) -> Iterator[bytes]:
    """A gzip file's bytes in bounded pieces; further members and zero padding are read on."""
    view, at = memoryview(content), 0
    while at < len(view):
        stream = zlib.decompressobj(GZIP)
        while not stream.eof:
            if not stream.unconsumed_tail:
                fed, at = bytes(view[at : at + CHUNK]), at + CHUNK
                if not fed:
                    raise ValueError("the gzip stream is cut off")
            else:
                fed = stream.unconsumed_tail
            if piece := stream.decompress(fed, CHUNK):
                yield piece
        at = min(at, len(view)) - len(stream.unused_data)
        while at < len(view) and view[at] == 0:
            at += 1


def ended(gzip_bytes: bytes) -> bytes:
    """The cell of a gzip file: its closing zero byte, if it has one, is left to the writer."""
    return gzip_bytes[:-1] if gzip_bytes.endswith(b"\0") else gzip_bytes


def archive_of(path: Column) -> Column:
    """The number of an archive, which its sidecar shares."""
    return F.regexp_extract(path, r"archive=(\d+)", 1).cast("long")


def write_streams(pages: DataFrame, path: str, stream_bytes: int = STREAM_BYTES) -> None:
    """Write ``pages`` (page_id, url, html) as archives of one gzip stream each."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("sha", F.sha1("payload"))
    keepers = (
        rows.where(F.octet_length("payload") >= REVISIT_BYTES)
        .groupBy("sha")
        .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("sha", "keeper")
    )
    linked = rows.join(keepers, "sha", "left").select("page_id", "url", "payload", "keeper")

    def streams(found: Iterator[tuple]) -> Iterable[tuple]:
        packer, out, size = None, [], 0
        for page_id, url, payload, keeper in found:
            revisit = keeper is not None and page_id != keeper
            packer = packer or zlib.compressobj(1, zlib.DEFLATED, GZIP)
            out.append(packer.compress(render(page_id, url, payload, keeper, revisit)))
            size += len(out[-1])
            if size >= stream_bytes:
                yield (ended(b"".join([*out, packer.flush()])),)
                packer, out, size = None, [], 0
        if packer:
            yield (ended(b"".join([*out, packer.flush()])),)

    write_cells(arrow_map(linked, streams, "value binary", rows=1), path)


def normalise(spark: SparkSession, source: str, target: str) -> None:
    """Rewrite archives of whole-file gzip streams as one member per record, with a sidecar.

    ``target`` gets kind=warc and kind=index with a folder per archive; equal archive
    numbers belong together. An index file is gzipped JSON lines.
    """

    def rewritten(found: Iterator[tuple]) -> Iterable[tuple]:
        task = TaskContext.get().partitionId()
        for nth, (_, content) in enumerate(found):
            members, lines, at = [], [], 0
            for headers, raw in records(inflated(content)):
                packer = zlib.compressobj(6, zlib.DEFLATED, GZIP)
                member = packer.compress(raw) + packer.flush()
                entry = {
                    "offset": at,
                    "length": len(member),
                    "type": headers["warc-type"],
                    "id": headers["warc-record-id"],
                    "digest": headers.get("warc-payload-digest"),
                }
                lines.append(json.dumps(entry).encode() + b"\n")
                members.append(member)
                at += len(member)
            if members:
                archive = (task << 32) + nth
                packer = zlib.compressobj(6, zlib.DEFLATED, GZIP)
                index = packer.compress(b"".join(lines)) + packer.flush()
                yield "warc", archive, ended(b"".join(members))
                yield "index", archive, ended(index)

    fields = "kind string, archive long, value binary"
    write_cells(arrow_map(read_cells(spark, source), rewritten, fields, rows=1), target, "kind", "archive")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """part, offset, length, type, id, digest of every record, from the sidecars."""

    def lines(found: Iterator[tuple]) -> Iterable[tuple]:
        for part, content in found:
            for line in b"".join(inflated(content)).splitlines():
                e = json.loads(line)
                yield part, e["offset"], e["length"], e["type"], e["id"], e["digest"]

    files = read_cells(spark, f"{path}/kind=index").select(archive_of(F.col("path")), "content")
    return arrow_map(files, lines, "part long, offset long, length long, type string, id string, digest string")


def members(content: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, inflated bytes) of each gzip member of an archive."""
    view, at = memoryview(content), 0
    while at < len(view):
        stream, out, fed = zlib.decompressobj(GZIP), [], at
        while not stream.eof:
            if fed >= len(view):
                raise ValueError("the last member is cut off")
            out.append(stream.decompress(view[fed : fed + (1 << 16)]))
            fed = min(fed + (1 << 16), len(view))
        end = fed - len(stream.unused_data)
        yield at, end - at, b"".join(out)
        at = end
        while at < len(view) and view[at] == 0:
            at += 1


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of normalised archives, in which archive and sidecar agree.

    page_id, url, payload_bytes, payload_digest,
    record_type, refers_to. A response whose payload does not give its digest, and
    a sidecar line that no member answers to, raise.
    """

    def parsed(found: Iterator[tuple]) -> Iterable[tuple]:
        for part, content in found:
            for offset, length, raw in members(content):
                (headers, record), = records([raw])
                block = record.partition(b"\r\n\r\n")[2][: int(headers["content-length"])]
                http, _, payload = block.partition(b"\r\n\r\n")
                digest = headers["warc-payload-digest"].removeprefix("sha1:")
                kind = headers["warc-type"]
                size = next(int(x[15:]) for x in http.decode().split("\r\n") if x.lower().startswith("content-length:"))
                if kind == "response" and (base32_sha1(payload) != digest or len(payload) != size):
                    raise ValueError(f"record {headers['warc-record-id']} does not match its digest")
                refers = headers.get("warc-refers-to")
                yield (
                    part, offset, length, page_of(headers["warc-record-id"]), headers.get("warc-target-uri"), size,
                    digest, kind, page_of(refers) if refers else None, headers["warc-record-id"],
                )

    files = read_cells(spark, f"{path}/kind=warc").select(archive_of(F.col("path")), "content")
    fields = (
        "part long, offset long, length long, page_id long, url string, payload_bytes long, payload_digest string, "
        "record_type string, refers_to long, id string"
    )
    found = arrow_map(files, parsed, fields)
    index = read_index(spark, path).withColumn("digest", F.substring_index("digest", ":", -1))
    met = found.join(
        index.withColumnsRenamed({"type": "i_type", "id": "i_id"}), ["part", "offset", "length"], "full"
    )
    agrees = F.col("digest").eqNullSafe(F.col("payload_digest")) & F.col("i_id").eqNullSafe(F.col("id"))
    checked = F.when(agrees & (F.col("i_type") == F.col("record_type")), F.col("record_type")).otherwise(
        F.raise_error(F.lit("archive and sidecar differ")).cast("string")
    )
    return met.withColumn("record_type", checked).drop("i_type", "i_id", "digest", "id", "part", "offset", "length")
