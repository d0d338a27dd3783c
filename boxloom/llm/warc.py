"""WARC archives: a writer, and a reader whose tasks scan byte ranges.

The writer makes one gzip member for each record. The reader cuts archives into
byte ranges. A task searches its range for the first place where gzip's magic
bytes begin a member that decodes to WARC headers; from there it walks from member
to member, and it owns every record that starts in its range, the last of which it
reads past the range's end. So each record is read once, wherever the cuts fall.
Headers may be of any length: what begins as a record is read on to its blank line,
and fails the task if it has none or is damaged; it is never skipped. Stored (not
deflated) data that hold a whole archive of their own could be taken for records if a
range began within them; the writer always deflates.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import store
from .wordhash import runs

#: A shorter payload is never replaced by a revisit.
LEAST_REVISIT = 1000
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/"
BLOCK = 1 << 20
#: Bytes given to the decoder at once.
CHUNK = 1 << 16


def _record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    sha = "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    name = "" if page is None else page
    lines = ["WARC/1.1", "WARC-Type: " + ("response" if refers_to is None else "revisit"), f"WARC-Record-ID: <urn:page:{name}>", "WARC-Date: 2000-01-01T00:00:00Z"]
    if url and not re.search(r"[\r\n]", url):
        lines.append(f"WARC-Target-URI: {url}")
    lines += [f"WARC-Payload-Digest: {sha}", "Content-Type: application/http; msgtype=response"]
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines.append(f"Content-Length: {len(block)}")
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """Writes one record for each row and returns a stored table (path, size, records).

    Of rows with equal payloads of LEAST_REVISIT bytes or more, those with the
    largest key are responses and the others revisit it; a repeated row of that key
    is a response too, and so are all rows of a payload whose keys are all null. A
    null body is an empty payload, and a null or broken url has no target header.
    Each input partition makes one archive; archives that are not in the returned
    table (a task that ran twice) do not count. Digests and keys are shuffled; payloads
    only where repeated payloads are so many that their table cannot be broadcast, and
    then by key and digest, so that a common payload is not one task's."""
    rows = pages.select(F.col(key).cast("bigint").alias("page"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(body).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    # no payload's digest is equal to a shorter one's, so the joins need no length
    narrow = rows.where(F.octet_length("payload") >= LEAST_REVISIT).select("page", "digest")
    targets = narrow.groupBy("digest").agg(F.max("page").alias("target"), F.count("*").alias("n")).where("n > 1")
    targets, several = store.counted(targets.select(F.col("digest").alias("same"), "target"), "targets")
    own = ~F.col("target").eqNullSafe(F.col("page"))
    if several["n"] <= store.BROADCAST_ROWS:
        rows = rows.join(F.broadcast(targets), F.col("digest") == F.col("same"), "left").withColumn("refers_to", F.when(own, F.col("target")))
    else:
        revisits = narrow.join(targets, F.col("digest") == F.col("same")).where(own).select(F.col("page").alias("by"), "same", F.col("target").alias("refers_to")).distinct()
        rows = rows.join(revisits, F.col("page").eqNullSafe(F.col("by")) & (F.col("digest") == F.col("same")), "left")
    rows = rows.select("page", "url", "payload", "digest", "refers_to")

    def put(batches):
        sink, count, name = None, 0, ""
        for batch in batches:
            for part in runs(batch, "payload"):
                if sink is None:
                    fs, path = store.open_fs(folder)
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    sink = fs.open_output_stream(f"{path}/{name}", compression=None)
                for row in zip(*(part.column(c).to_pylist() for c in ("page", "url", "payload", "digest", "refers_to"))):
                    sink.write(_record(*row))
                    count += 1
        if sink is not None:
            size = sink.tell()
            sink.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "size": [size], "records": [count]})

    fs, path = store.open_fs(folder)
    fs.create_dir(path, recursive=True)
    return store.table(rows.mapInArrow(put, "path string, size bigint, records bigint"), "archives")


def _header(data: bytes, at: int) -> tuple[dict[str, str], int]:
    """A record's headers, by lower-case name, and where its block starts."""
    end = data.find(b"\r\n\r\n")
    lines = data[: max(end, 0)].decode("utf-8", "replace").split("\r\n")[1:]
    found = {k.strip().lower(): v.strip() for k, colon, v in (x.partition(":") for x in lines) if colon}
    if "warc-type" not in found or not found.get("content-length", "").isdigit():
        raise ValueError(f"the WARC record at byte {at} has no whole headers")
    return found, end + 4


class _Window:
    """Bytes of a file from any offset on, of which only the last are held."""

    def __init__(self, file, size: int, at: int):
        self.file, self.size, self.at, self.data = file, size, at, b""

    def need(self, offset: int, length: int) -> bytes:
        """length bytes from offset on, fewer at the file's end."""
        if offset < self.at:
            self.data, self.at = b"", offset
        elif offset > self.at:
            keep = min(offset - self.at, len(self.data))
            self.data, self.at = self.data[keep:], self.at + keep
            if not self.data:
                self.at = offset
        while self.at + len(self.data) < min(offset + length, self.size):
            start = self.at + len(self.data)
            self.file.seek(start)
            more = self.file.read(min(max(BLOCK, length), self.size - start))
            if not more:
                raise EOFError(f"the archive ends at byte {start}, before its listed size {self.size}")
            self.data += more
        return self.data[offset - self.at : offset - self.at + length]


def _member(window: _Window, at: int, whole: bool) -> tuple[bytes, int] | None:
    """The data of the record's member at `at` and where it ends; None if no gzip member
    is there, or none that begins as a record does. Not whole: as much as the headers
    need, however long they are, and no end."""
    decoder, data, raw, offset = zlib.decompressobj(31), bytearray(), b"", at
    while not decoder.eof:
        if not raw:
            raw = window.need(offset, CHUNK if whole else 1 << 14)
            offset += len(raw)
        if not raw:
            break
        try:
            data += decoder.decompress(raw, CHUNK)
        except zlib.error:
            break
        raw = decoder.unconsumed_tail
        if len(data) >= len(VERSION) and not data.startswith(VERSION):
            return None
        if not whole and b"\r\n\r\n" in memoryview(data)[-CHUNK - 3 :].tobytes():
            return bytes(data), -1
    if not data.startswith(VERSION):
        return None
    if not decoder.eof:
        raise ValueError(f"the WARC record at byte {at} is damaged")
    return bytes(data), offset - len(decoder.unused_data)


def scan_range(file, size: int, start: int, end: int):
    """(offset, headers, block) of each record that starts in [start, end)."""
    window, at = _Window(file, size, start), start
    while at < end:  # the first member
        raw = window.need(at, BLOCK)
        found = raw.find(MAGIC)
        if found < 0:
            at += max(1, len(raw) - 2)
            continue
        at += found
        if at >= end:
            return
        head = _member(window, at, False)
        if head:
            _header(head[0], at)
            break
        at += 1
    while at < end:
        member = _member(window, at, True)
        if not member:
            raise ValueError(f"no WARC record at byte {at}")
        fields, body = _header(member[0], at)
        yield at, fields, member[0][body : body + int(fields["content-length"])]
        at = member[1]


RECORDS = "path string, at bigint, record_type string, record_id string, target_uri string, refers_to string, payload_digest string, http_length bigint, payload binary"


def read(archives: DataFrame, split_bytes: int = 64 << 20, payloads: bool = True) -> DataFrame:
    """The records of archives (path, size), by byte ranges of split_bytes.

    payload is what follows the HTTP headers of the block, or the block where it has
    none; a payload_digest is lower-case hex, of what was read for responses and of
    the header for revisits. http_length is the HTTP Content-Length. Archives without
    records give none; a damaged member fails the task."""
    spark = archives.sparkSession
    cuts = archives.where("size > 0").select("path", "size", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("size") - 1, F.lit(split_bytes).cast("bigint"))).alias("start"))
    ranges = archives.agg(F.sum(F.ceil(F.col("size") / split_bytes))).first()[0] or 1

    def scan(batches):
        for batch in batches:
            for path, size, start in zip(*(batch.column(c).to_pylist() for c in ("path", "size", "start"))):
                fs, name = store.open_fs(path)
                out, held = [], 0
                with fs.open_input_file(name) as file:
                    for at, head, block in scan_range(file, size, start, min(size, start + split_bytes)):
                        http, gap, payload = block.partition(b"\r\n\r\n") if block.startswith(b"HTTP/") else (b"", b"", block)
                        length = re.search(rb"(?im)^content-length:\s*(\d+)", http)
                        kind = head["warc-type"]
                        given = head.get("warc-payload-digest", "").removeprefix("sha1:")
                        digest = hashlib.sha1(payload).hexdigest() if kind != "revisit" else base64.b32decode(given).hex() if given else None
                        out.append((path, at, kind, head.get("warc-record-id"), head.get("warc-target-uri"), head.get("warc-refers-to"), digest, int(length[1]) if length else None, payload if payloads else None))
                        held += len(payload)
                        if held > 4 << 20 or len(out) >= 4096:
                            yield _batch(out)
                            out, held = [], 0
                if out:
                    yield _batch(out)

    return cuts.repartition(min(int(ranges), max(store.partitions(spark), 1) * 64)).mapInArrow(scan, RECORDS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)], names=[x.split()[0] for x in RECORDS.split(", ")])


def page_of(name: str) -> Column:
    """The page id in a column of the writer's record ids, null where it has none."""
    return F.expr(f"try_cast(nullif(regexp_extract({name}, '^<urn:page:(-?[0-9]+)>$', 1), '') as bigint)")


def round_trip(pages: DataFrame, split_bytes: int = 64 << 20) -> DataFrame:
    """Writes pages as archives in the shared folder and reads them back."""
    folder = store.fresh_dir(pages.sparkSession, "warc")
    found = read(write(pages, folder), split_bytes, payloads=True)
    return found.select(
        page_of("record_id").alias("page_id"),
        F.when(F.col("record_type") == "revisit", F.col("http_length")).otherwise(F.octet_length("payload").cast("bigint")).alias("payload_bytes"),
        "payload_digest",
        "record_type",
        page_of("refers_to").alias("refers_to"),
    )
