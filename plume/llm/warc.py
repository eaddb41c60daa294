"""WARC archives: a writer that records repeated payloads once, and a splittable reader.

*Writing.*  Every page becomes one gzip member (a record of its own, so that a
reader can start at any of them).  Payloads are compared by SHA-256; of equal
ones of ``MIN_REVISIT`` bytes or more the smallest page_id is written as
``response`` and the others as ``revisit`` with the response's record id and no
payload.  Pages are written where they are scanned: only the digests that occur
twice are joined to them, by a broadcast if a count proves them few, else by a
join whose keys are salted, so that one payload held by a third of all pages is
spread over ``SALTS`` tasks.  A task writes files of its own below a shared
folder and returns a manifest row for each one it has closed; the manifest holds
the rows of successful attempts alone, so files of dead attempts are never read.

*Reading.*  Archives are cut into byte ranges without regard to records.  A task
scans its range for the gzip magic, takes each place as a candidate and decodes
it: a member counts only if its header is plain, its first bytes spell a WARC
version, its checksum holds and the record's own length agrees.  The task owns
every record that *starts* inside its range, follows it past the end if need be,
and goes on after it; a place inside compressed data fails the decoding and the
scan moves one byte on.  No index and no other task is needed.  Memory: a block
and the longest record.

Defined results: NULL html is an empty payload, NULL urls have no target
header, control characters in urls are percent-encoded.  A NULL page_id counts
as larger than any other; if all are NULL, or the smallest page_id repeats, all
rows that have it are responses.  Records that begin like WARC but are cut off or
do not agree with their checksum, length or digest come back as ``damaged``; the
scan goes on behind them.  A foreign archive whose *stored* (not compressed)
blocks hold whole WARC members could show those as records; valid UTF-8 cannot
hold the magic.  Extra columns are not read.

Paths are whatever ``pyarrow.fs`` opens (file, hdfs, s3, gs).
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plume.session import scratch_path

from .tables import staged

MIN_REVISIT = 100
LEVEL = 6
ARCHIVE_BYTES = 256 << 20
SPLIT_BYTES = 8 << 20
BLOCK = 1 << 20
BATCH_BYTES = 4 << 20
MAX_BROADCAST_ROWS = 200_000     #: rows of fixed size (a digest and an id): about 20 MB
SALTS = 64
MAX_TASKS = 100_000
DATE = "1970-01-01T00:00:00Z"    #: the pages carry no time; archives of equal pages are equal

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CONTROL = re.compile(r"[\x00-\x20\x7f]")


# ---- writing ---------------------------------------------------------------

def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [("WARC-Type", kind), *fields, ("Content-Length", str(len(block)))])
    return zlib.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n", LEVEL, wbits=31)


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """The record of a page: a revisit if it refers to another one."""
    fields = [("WARC-Record-ID", record_id(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url)))
    fields += [("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        return record("response", fields, block + payload)
    return record("revisit", [*fields, ("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", PROFILE)], block)


MANIFEST = "path string, bytes long, records long"


def _writer(folder: str, archive_bytes: int):
    """Arrow batches of (page_id, url, html, digest, refers_to) -> manifest rows of the files written."""
    def run(batches):
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        name = out = None
        size = records = 0

        def row():
            return pa.RecordBatch.from_pylist([{"path": name, "bytes": size, "records": records}],
                                              pa.schema([("path", pa.string()), ("bytes", pa.int64()),
                                                         ("records", pa.int64())]))
        for batch in batches:
            for page_id, url, page, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    leaf = f"part-{uuid.uuid4().hex}.warc.gz"
                    name, size, records = f"{folder}/{leaf}", 0, 0
                    out = system.open_output_stream(f"{root}/{leaf}", compression=None)
                    first = record("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE),
                                                ("Content-Type", "application/warc-fields")], b"format: WARC/1.1\r\n")
                    out.write(first)
                    size += len(first)
                member = page_record(page_id, url, (page or "").encode(), digest, refers_to)
                out.write(member)
                size += len(member)
                records += 1
                if size >= archive_bytes:
                    out.close()
                    yield row()
                    out = None
        if out is not None:
            out.close()
            yield row()
    return run


def write_warc(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the pages below ``folder``; the manifest (path, bytes, records) of the archives."""
    payload = F.coalesce(pages["html"].cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"),
                        pages["html"].cast("string").alias("html"), F.sha2(payload, 256).alias("digest"),
                        (F.octet_length(payload) >= MIN_REVISIT).alias("long_enough"))
    twice = staged(rows.where("long_enough").groupBy(F.unhex("digest").alias("d"))
                   .agg(F.count("*").alias("copies"), F.min("page_id").alias("first"))
                   .where("copies > 1").select("d", "first"), "warc-repeated")
    keyed = rows.withColumn("d", F.when(F.col("long_enough"), F.unhex("digest")))
    if twice.count() <= MAX_BROADCAST_ROWS:
        joined = keyed.join(F.broadcast(twice), "d", "left")
    else:
        joined = (keyed.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)))
                  .join(twice.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))),
                        ["d", "salt"], "left"))
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    ready = joined.select("page_id", "url", "html", "digest", F.when(other, F.col("first")).alias("refers_to"))
    return staged(ready.mapInArrow(_writer(folder, archive_bytes), MANIFEST), "warc-manifest")


# ---- reading ---------------------------------------------------------------

class Source:
    """Bytes of a file from a moving place on, read block by block."""

    def __init__(self, file, size: int, start: int):
        self.file, self.size = file, size
        self.base, self.held = start, b""

    def end(self) -> int:
        return self.base + len(self.held)

    def more(self) -> bool:
        """Read another block; False at the end of the file."""
        n = min(BLOCK, self.size - self.end())
        if n <= 0:
            return False
        self.held += self.file.read_at(n, self.end())
        return True

    def forget(self, at: int) -> None:
        """Bytes before ``at`` are not needed any more."""
        if at - self.base >= BLOCK:
            self.held, self.base = self.held[at - self.base:], at


def candidate(src: Source, stop: int, at: int) -> int | None:
    """The next gzip magic in [at, stop)."""
    while at < stop:
        k = src.held.find(MAGIC, at - src.base)
        if k >= 0:
            return src.base + k if src.base + k < stop else None
        at = max(at, src.end() - len(MAGIC) + 1)
        src.forget(at)
        if src.end() >= stop + len(MAGIC) or not src.more():
            return None
    return None


def member(src: Source, at: int) -> tuple[bytes | None, int, bool]:
    """(decoded bytes or None, end of the member, did it begin like a WARC record?)."""
    while src.end() < at + 10 and src.more():
        pass
    head = src.held[at - src.base:at - src.base + 10]
    if len(head) < 10 or head[3] & 0xE0:  # reserved flags
        return None, at, False
    while True:
        try:
            first = zlib.decompressobj(wbits=31).decompress(src.held[at - src.base:at - src.base + 4096], len(VERSION))
        except zlib.error:
            return None, at, False
        if len(first) == len(VERSION) or src.end() >= at + 4096 or not src.more():
            break
    if first != VERSION:
        return None, at, False
    unzip, parts, fed = zlib.decompressobj(wbits=31), [], at
    try:
        while not unzip.eof:
            if fed >= src.end() and not src.more():
                return None, at, True
            piece = src.held[fed - src.base:fed - src.base + (1 << 16)]
            parts.append(unzip.decompress(piece))
            fed += len(piece)
    except zlib.error:
        return None, at, True
    return b"".join(parts), fed - len(unzip.unused_data), True


def fields(head: bytes) -> dict[str, str]:
    """Header lines after the first, names in lower case."""
    out = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            out[name.strip().lower()] = value.strip()
    return out


def parsed(raw: bytes) -> dict | None:
    """A record's row from its decoded bytes; None if its parts do not agree."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    own = fields(head)
    if not gap or not own.get("content-length", "").isdigit() or "warc-type" not in own:
        return None
    n = int(own["content-length"])
    if rest[n:] != b"\r\n\r\n":
        return None
    block = rest[:n]
    kind, payload, size = own["warc-type"], block, None
    if own.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        length = fields(http).get("content-length", "")
        size = int(length) if length.isdigit() else None
    told = own.get("warc-payload-digest", "")
    digest = told.removeprefix("sha256:").lower() if told.startswith("sha256:") else None
    if kind == "revisit":
        payload = None
    else:
        size = len(payload)
        real = hashlib.sha256(payload).hexdigest()
        if digest is not None and digest != real:
            return None
        digest = real
    return {"record_id": own.get("warc-record-id"), "record_type": kind, "url": own.get("warc-target-uri"),
            "payload_bytes": size, "payload_digest": digest, "refers_to": own.get("warc-refers-to"), "payload": payload}


def records(file, size: int, start: int, stop: int):
    """Rows of the records that start in [start, stop), with their place."""
    src, at = Source(file, size, start), start
    while (at := candidate(src, stop, at)) is not None:
        raw, end, warc = member(src, at)
        row = parsed(raw) if raw is not None else None
        if row is None and warc:
            row = {"record_type": "damaged"}
        if row is not None:
            yield {**row, "offset": at}
        at = end if raw is not None else at + 1
        src.forget(at)


RECORDS = ("path string, offset long, record_id string, record_type string, url string, payload_bytes long, "
           "payload_digest string, refers_to string, payload binary")
RECORD_ARROW = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("record_id", pa.string()),
                          ("record_type", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                          ("payload_digest", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary())])


def _read_batches(batches):
    """Arrow batches of (path, start, stop, bytes) -> records."""
    for batch in batches:
        for path, start, stop, size in zip(*(c.to_pylist() for c in batch.columns)):
            system, name = fs.FileSystem.from_uri(path)
            held, weight = [], 0
            with system.open_input_file(name) as file:
                for row in records(file, size, start, stop):
                    held.append({"path": path, **row})
                    weight += 500 + len(row.get("payload") or b"")
                    if weight >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(held, RECORD_ARROW)
                        held, weight = [], 0
            if held:
                yield pa.RecordBatch.from_pylist(held, RECORD_ARROW)


def splits(manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(path, start, stop, bytes): every archive cut into byte ranges, dealt out evenly."""
    out = (manifest.where("bytes > 0")
           .select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1,
                                                         F.lit(split_bytes).cast("long"))).alias("start"))
           .select("path", "start", F.least(F.col("start") + split_bytes, "bytes").alias("stop"), "bytes"))
    n = manifest.agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0] or 1
    return out.repartition(max(1, min(int(n), MAX_TASKS)))


def read_warc(manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """All records of the archives in ``manifest`` (path, bytes)."""
    return splits(manifest, split_bytes).mapInArrow(_read_batches, RECORDS)


def archive_and_read(pages: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Write the pages as WARC to the shared folder and read the archives back: one row per page."""
    manifest = write_warc(pages, scratch_path(pages.sparkSession, "warc"))

    def page(column):
        return F.regexp_extract(column, r"<urn:x-page:(-?\d+)>", 1)
    found = read_warc(manifest, split_bytes).where("record_type <> 'warcinfo'")
    return found.select(
        F.when(page("record_id") != "", page("record_id")).cast("long").alias("page_id"), "payload_bytes",
        "payload_digest", "record_type", F.when(page("refers_to") != "", page("refers_to")).cast("long").alias("refers_to"))
