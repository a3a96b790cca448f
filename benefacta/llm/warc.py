"""WARC archives: a writer with revisit records, and a splittable reader.

Writer: each record is a gzip member of its own, as the format asks. Pages with equal payloads (SHA-1 of the UTF-8 text, a
null being empty) share one response record, that of the least page id; the others become revisit records, which keep the HTTP
header with the payload's length, its digest, and the id of the response. Payloads below ``least_bytes`` are always responses. Each task
writes a file of its own under a fresh name and reports it; only reported files belong to the archive, so a task that is
repeated leaves no double records.

Reader: archives are cut into byte ranges, one task takes some of them. A task looks for the gzip magic in its range, validates
each candidate by decoding it to the end of its member, and owns the records that start inside its range, reading past its
end where a record does. From a valid record it goes on behind its member; a member that breaks off is skipped. Magic bytes
inside a member are told apart by decoding; a payload of text never holds them, since they are no UTF-8. Every task holds one
record at a time. Files are opened through Arrow's file systems by URI, so any store that these know will do.

Rows that repeat the least page id of their payload are all responses. A null page id has an empty record id; it is a response only if all pages of its
payload lack an id.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path, materialise

MAGIC = b"\x1f\x8b\x08"
END = b"\r\n\r\n"
RANGE_BYTES = 8 << 20
READ_BYTES = 1 << 16
READ_TASKS = 50_000
DATE = "2000-01-01T00:00:00Z"
_URN = "urn:page:"


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", uri))


def base32_digest(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode("ascii")


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to, date: str = DATE) -> bytes:
    """One WARC record; with ``refers_to`` a revisit, which leaves the payload out."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <{_URN}{'' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    if revisit:
        head += [f"WARC-Refers-To: <{_URN}{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(head).encode() + END + block + END


def member(data: bytes, level: int = 1) -> bytes:
    packed = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packed.compress(data) + packed.flush()


def write_archive(pages: DataFrame, folder: str, payload: str = "html", url: str = "url", page: str = "page_id",
                  least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to ``folder``; returns the stored manifest ``path``, ``bytes``, ``records``."""
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(F.col(page).alias("page_id"), F.col(url).alias("url"), body.alias("payload"), F.sha1(body.cast("binary")).alias("digest"))
    firsts = rows.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    firsts = materialise(firsts.select(F.col("digest").alias("of"), "first"), "first-pages")
    marked = rows.join(firsts, F.col("digest") == F.col("of"), "left").select("page_id", "url", "payload", "digest", F.when(
        ~F.col("page_id").eqNullSafe(F.col("first")) & (F.octet_length("payload") >= least_bytes), F.col("first")).alias("refers_to"))

    def write(batches):
        store, path, out, records = None, None, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                store, root = open_store(folder)
                store.create_dir(root, recursive=True)
                name = f"{uuid.uuid4().hex}.warc.gz"
                path, out = f"{folder}/{name}", store.open_output_stream(f"{root}/{name}", compression=None)
            for page_id, target, text, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                out.write(member(record(page_id, target, text.encode(), base32_digest(digest), refers_to)))
                records += 1
        if out is not None:
            size = out.tell()
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "bytes": [size], "records": [records]})

    return materialise(marked.mapInArrow(write, "path string, bytes long, records long"), "manifest")


class _Window:
    """Bytes of a file from a moving place on, read in steps."""

    def __init__(self, file, size: int, at: int):
        self.file, self.size, self.start, self.data = file, size, at, b""

    def seek(self, at: int) -> None:
        if self.start <= at <= self.start + len(self.data):
            self.data = self.data[at - self.start:]
        else:
            self.data = b""
        self.start = at

    def more(self) -> bytes:
        at = self.start + len(self.data)
        self.file.seek(at)
        read = self.file.read(min(READ_BYTES, max(self.size - at, 0)))
        self.data += read
        return read


def _decode(window: _Window, at: int) -> tuple[bytes, int] | None:
    """Content and end of the member at ``at``, or None if no whole member with a WARC header is there. A header may be of any length."""
    window.seek(at)
    unpack, parts, begin, tail, headed = zlib.decompressobj(31), [], b"", b"", False
    piece, fed = window.data or window.more(), 0
    while piece:
        try:
            part = unpack.decompress(piece)
        except zlib.error:
            return None
        fed += len(piece)
        parts.append(part)
        begin = (begin + part[:5])[:5]
        if not b"WARC/".startswith(begin):
            return None
        if not headed:
            tail = tail[-3:] + part  # the blank line may lie across two parts
            headed = END in tail
        if unpack.eof:
            return (b"".join(parts), at + fed - len(unpack.unused_data)) if headed else None
        piece = window.more()
    return None


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and blocks of the records in a member."""
    at = 0
    while content.startswith(b"WARC/", at):
        stop = content.find(END, at)
        lines = content[at:stop].decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        length = int(headers.get("content-length", 0))
        yield headers, content[stop + 4:stop + 4 + length]
        at = stop + 4 + length + len(END)


def read_range(file, size: int, start: int, stop: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Place, headers and block of the records whose members start in ``[start, stop)``."""
    window, at = _Window(file, size, start), start
    while at < stop:
        window.seek(at)
        while len(window.data) < 3 and window.more():
            pass
        found = window.data.find(MAGIC)
        if found < 0:
            if not window.data or window.start + len(window.data) >= size:
                return
            at = max(at + 1, window.start + len(window.data) - 2)  # the magic may lie across two reads
            continue
        at += found
        if at >= stop:
            return
        decoded = _decode(window, at)
        if decoded is None:
            at += 1
            continue
        for headers, block in parse(decoded[0]):
            yield at, headers, block
        at = decoded[1]


def read_archive(spark: SparkSession, manifest: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Records of the files of a manifest (``path``, ``bytes``), read by byte ranges.

    ``path``, ``place``, ``record_type``, ``page_id``, ``url``, ``payload_digest`` (as declared), ``payload_bytes`` (of the full
    payload), ``refers_to``, ``payload`` (null for revisits) and ``intact`` (a response's payload fits its digest and length).
    """
    ranges = manifest.where("bytes > 0").select("path", "bytes", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
    names = ["path", "place", "record_type", "page_id", "url", "payload_digest", "payload_bytes", "refers_to", "payload", "intact"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]

    def number(urn: str | None):
        found = re.fullmatch(rf"<{_URN}(-?\d+)>", urn or "")
        return int(found[1]) if found else None

    def row(path, place, headers, block):
        http, _, payload = block.partition(END)
        length = re.search(rb"(?im)^content-length:\s*(\d+)", http)
        n = int(length[1]) if length else len(payload)
        digest = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
        kind = headers.get("warc-type")
        whole = kind != "revisit"
        intact = not whole or len(payload) == n and base32_digest(hashlib.sha1(payload).hexdigest()) == digest
        return (path, place, kind, number(headers.get("warc-record-id")), headers.get("warc-target-uri"), digest, n,
                number(headers.get("warc-refers-to")), payload if whole else None, intact)

    def read(batches):
        for batch in batches:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns)):
                store, inner = open_store(path)
                rows, held = [], 0
                with store.open_input_file(inner) as file:
                    for found in read_range(file, size, start, min(start + range_bytes, size)):
                        rows.append(row(path, *found))
                        held += len(found[2]) + len(found[1].get("warc-target-uri", ""))
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    # a range is a few bytes of its own, so adaptive execution would put all of them into one task
    tasks = ranges.agg(F.least(F.count("*"), F.lit(READ_TASKS))).first()[0]
    schema = ("path string, place long, record_type string, page_id long, url string, payload_digest string, payload_bytes long, "
              "refers_to long, payload binary, intact boolean")
    return ranges.repartition(max(tasks, 1), "path", "start").mapInArrow(read, schema)


def round_trip(pages: DataFrame, least_bytes: int = 0, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Write ``pages`` to a fresh archive in the shared folder and read its records back."""
    spark = pages.sparkSession
    manifest = write_archive(pages, fresh_path(spark, "warc"), least_bytes=least_bytes)
    return read_archive(spark, manifest, range_bytes)
