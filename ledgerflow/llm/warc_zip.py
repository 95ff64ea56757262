"""WARC archives packaged in ZIP files: written by tasks, read by range without extraction.

A package holds ``archive/data.warc.gz`` (one gzip member a record) and
``indexes/index.cdxj`` (one line a record: key, offset, length), both stored
without ZIP compression, so a record is one byte range of the package. The
reader parses the end record, the ZIP64 end record where there is one, and the
central directory, finds the stored members, and reads the index and then runs
of neighbouring records by range. A package without an index is scanned record
by record.

Defined cases: a null payload is empty; a null ``page_id`` is kept, ranks lowest
and comes back null; of rows with equal payload and equal largest ``page_id``
one is the response. Repeated rows are records of their own. An empty table gives
no package. A compressed or encrypted WARC member, or a file without a ZIP end
record, raises ``ValueError``. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm.common import materialize, shuffle_tasks
from ledgerflow.session import scratch_path

WARC_MEMBER = "archive/data.warc.gz"
INDEX_MEMBER = "indexes/index.cdxj"
RUN_BYTES = 4 << 20  # neighbouring records are read together up to this size
RECORD_SCHEMA = ("archive string, offset long, length long, record_type string, record_id string, refers_to_id string, "
                 "target_uri string, payload_digest string, payload_bytes long, payload binary")


# ------------------------------------------------------------------ records

def _header_lines(fields: list[tuple[str, str | None]]) -> bytes:
    return b"".join(f"{k}: {v}\r\n".encode() for k, v in fields if v is not None)


def base32_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def encode_record(record_id: str, uri: str | None, payload: bytes, date: str, refers_to: str | None = None) -> bytes:
    """One WARC/1.1 record as a gzip member: a response, or a revisit of ``refers_to``."""
    http = b"HTTP/1.1 200 OK\r\n" + _header_lines([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))]) + b"\r\n"
    block = http if refers_to else http + payload
    uri = None if uri is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri)
    head = b"WARC/1.1\r\n" + _header_lines([
        ("WARC-Type", "revisit" if refers_to else "response"), ("WARC-Record-ID", f"<{record_id}>"),
        ("WARC-Target-URI", uri), ("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{base32_digest(payload)}"),
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if refers_to else None),
        ("WARC-Refers-To", f"<{refers_to}>" if refers_to else None),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))])
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(head + b"\r\n" + block + b"\r\n\r\n") + pack.flush()


def decode_record(raw: bytes) -> dict:
    """The fields and payload of one uncompressed record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    told = re.search(rb"(?im)^content-length:\s*(\d+)", http)
    kind = fields.get("warc-type")
    return {"record_type": kind, "record_id": fields.get("warc-record-id", "").strip("<>"),
            "refers_to_id": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
            "target_uri": fields.get("warc-target-uri"),
            "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:"),
            "payload_bytes": int(told[1]) if kind == "revisit" and told else len(payload),
            "payload": None if kind == "revisit" else payload}


# ------------------------------------------------------------------ ZIP directory

@dataclass(frozen=True)
class Member:
    name: str
    method: int
    flags: int
    size: int
    stored_size: int
    header_at: int


def _read(f, at: int, n: int) -> bytes:
    got = f.read_at(n, at)
    if len(got) != n:
        raise ValueError("the archive ends early")
    return bytes(got)


def zip_members(f) -> list[Member]:
    """Central directory of an open random-access file, with ZIP64 sizes and offsets."""
    size = f.size()
    tail_at = max(0, size - 65557)  # an end record is 22 bytes and a comment of up to 65,535
    tail = _read(f, tail_at, size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and (len(tail) - at < 22 or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("no ZIP end record")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    end_at = tail_at + at
    if 0xFFFF == count or 0xFFFFFFFF in (length, start):
        locator = _read(f, end_at - 20, 20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        end64 = _read(f, struct.unpack_from("<Q", locator, 8)[0], 56)
        if end64[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end record")
        count, length, start = struct.unpack_from("<QQQ", end64, 32)
    directory, members, p = _read(f, start, length), [], 0
    for _ in range(count):
        if directory[p:p + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", directory, p + 8)
        stored, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", directory, p + 20)
        header_at = struct.unpack_from("<I", directory, p + 42)[0]
        name = directory[p + 46:p + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra, q = directory[p + 46 + n_name:p + 46 + n_name + n_extra], 0
        while q + 4 <= len(extra):
            tag, n = struct.unpack_from("<HH", extra, q)
            if tag == 1:  # ZIP64: only the fields that overflow, in this order
                values = iter(struct.unpack_from(f"<{n // 8}Q", extra, q + 4))
                plain = next(values) if plain == 0xFFFFFFFF else plain
                stored = next(values) if stored == 0xFFFFFFFF else stored
                header_at = next(values) if header_at == 0xFFFFFFFF else header_at
            q += 4 + n
        members.append(Member(name, method, flags, plain, stored, header_at))
        p += 46 + n_name + n_extra + n_comment
    return members


def data_start(f, m: Member) -> int:
    """File offset of a stored member's first byte."""
    if m.method or m.flags & 1:
        raise ValueError(f"{m.name} is compressed or encrypted, so it has no byte ranges")
    head = _read(f, m.header_at, 30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("broken local header")
    return m.header_at + 30 + sum(struct.unpack_from("<HH", head, 26))


def record_ranges(f, members: list[Member]) -> Iterator[tuple[int, int]]:
    """Offset and length of each record within the WARC member, from the index."""
    index = next((m for m in members if m.name == INDEX_MEMBER), None)
    if index is None:
        return
    start, rest, done = data_start(f, index), b"", 0
    while done < index.size:
        piece = _read(f, start + done, min(RUN_BYTES, index.size - done))
        done += len(piece)
        *lines, rest = (rest + piece).split(b"\n")
        for line in lines:
            entry = json.loads(line[line.index(b"{"):])
            yield int(entry["offset"]), int(entry["length"])


def read_records(f) -> Iterator[tuple[int, int, bytes]]:
    """Every record of the package: offset within the WARC member, length, plain bytes."""
    members = zip_members(f)
    warc = next((m for m in members if m.name == WARC_MEMBER or m.name.startswith("archive/")), None)
    if warc is None:
        raise ValueError("no archive member")
    base = data_start(f, warc)
    if not any(m.name == INDEX_MEMBER for m in members):
        yield from _scan(f, base, warc.size)
        return
    run: list[tuple[int, int]] = []

    def flush():
        if run:
            block = _read(f, base + run[0][0], run[-1][0] + run[-1][1] - run[0][0])
            for offset, length in run:
                yield offset, length, zlib.decompress(block[offset - run[0][0]:offset - run[0][0] + length], 31)

    for offset, length in record_ranges(f, members):
        if run and (offset != run[-1][0] + run[-1][1] or offset + length - run[0][0] > RUN_BYTES):
            yield from flush()
            run = []
        run.append((offset, length))
    yield from flush()


def _scan(f, base: int, size: int) -> Iterator[tuple[int, int, bytes]]:
    at = start = 0
    unpack, out, held = zlib.decompressobj(31), [], b""
    while held or at < size:
        if not held:
            held = _read(f, base + at, min(RUN_BYTES, size - at))
            at += len(held)
        out.append(unpack.decompress(held))
        held = unpack.unused_data if unpack.eof else b""
        if unpack.eof:
            end = at - len(held)
            yield start, end - start, b"".join(out)
            start, unpack, out = end, zlib.decompressobj(31), []


# ------------------------------------------------------------------ Spark jobs

class _Sink:
    """A write-only file for ``zipfile``: members go out as they come."""

    def __init__(self, stream):
        self.write = stream.write
        self.flush = stream.flush


def _write_package(folder: str, rows: Iterator[tuple]) -> tuple[str, int]:
    store, root = pafs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    name = f"pages-{uuid.uuid4().hex}.wacz"  # a task attempt's own name: only listed packages are read
    index, n = [], 0
    with store.open_output_stream(f"{root}/{name}") as stream, zipfile.ZipFile(_Sink(stream), "w", zipfile.ZIP_STORED) as package:
        with package.open(zipfile.ZipInfo(WARC_MEMBER), "w", force_zip64=True) as member:
            at = 0
            for record_id, uri, payload, refers_to, date in rows:
                data = encode_record(record_id, uri, payload, date, refers_to)
                member.write(data)
                index.append((record_id, at, len(data)))
                at += len(data)
                n += 1
        with package.open(zipfile.ZipInfo(INDEX_MEMBER), "w", force_zip64=True) as member:
            for record_id, at, length in index:
                member.write(f'{record_id} {json.dumps({"offset": str(at), "length": str(length), "filename": WARC_MEMBER})}\n'.encode())
    return f"{folder}/{name}", n


def write_archives(pages: DataFrame, folder: str, min_payload: int = 0, date: str = "1970-01-01T00:00:00Z",
                   package_records: int = 50_000) -> DataFrame:
    """Write a record per row of ``pages(page_id, url, html)`` and return the written
    manifest ``archive, n_records``. Of records with equal payloads of at least
    ``min_payload`` bytes the one with the largest ``page_id`` is the response."""
    base = pages.select(F.monotonically_increasing_id().alias("rk"), F.col("page_id").cast("long").alias("page_id"),
                        F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    seen = base.select("rk", "page_id", F.sha1(F.col("html").cast("binary")).alias("digest"), F.octet_length("html").alias("size"))
    first = (seen.where(F.col("size") >= min_payload).groupBy("digest")
             .agg(F.max(F.struct("page_id", "rk")).alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    # Only digests and keys meet here; the join's row side can be split where a digest is frequent.
    again = (seen.where(F.col("size") >= min_payload).join(first, "digest").where(F.col("rk") != F.col("top.rk"))
             .select("rk", _record_id(F.col("top.rk"), F.col("top.page_id")).alias("refers_to")))
    rows = base.join(again, "rk", "left").select(_record_id(F.col("rk"), F.col("page_id")).alias("record_id"), "url",
                                                 F.col("html").cast("binary").alias("html"), "refers_to")

    def run(batches):
        records = (tuple(x) + (date,) for b in batches for x in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for head in records:
            def some(head=head):
                yield head
                for _, r in zip(range(package_records - 1), records):
                    yield r
            path, n = _write_package(folder, some())
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n])], names=["archive", "n_records"])

    return materialize(rows.mapInArrow(run, "archive string, n_records long"), "warc-manifest")


def _record_id(rk, page_id):
    return F.concat(F.lit("urn:page:"), rk.cast("string"), F.lit(":"), F.coalesce(page_id.cast("string"), F.lit("")))


def page_of(record_id):
    """The page id within a record id that ``write_archives`` made (null if it has none)."""
    return F.nullif(F.substring_index(record_id, ":", -1), F.lit("")).cast("long")


def read_archives(spark: SparkSession, archives: DataFrame) -> DataFrame:
    """Every record of the packages named in column ``archive``. A response whose
    payload does not have its recorded digest raises ``ValueError``."""
    def run(batches):
        names = ["archive", "offset", "length", "record_type", "record_id", "refers_to_id", "target_uri", "payload_digest", "payload_bytes", "payload"]
        kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary()]
        rows, held = [], 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names=names)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, at = pafs.FileSystem.from_uri(path)
                with store.open_input_file(at) as f:
                    for offset, length, raw in read_records(f):
                        r = decode_record(raw)
                        if r["payload"] is not None and r["payload_digest"] and base32_digest(r["payload"]) != r["payload_digest"]:
                            raise ValueError(f"{path}: the record at {offset} does not have its digest")
                        rows.append((path, offset, length, *(r[k] for k in names[3:])))
                        held += len(raw)
                        if held > RUN_BYTES:
                            yield out()
                            rows, held = [], 0
        if rows:
            yield out()

    return archives.select("archive").repartition(shuffle_tasks(archives), "archive").mapInArrow(run, RECORD_SCHEMA)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages into packages in the shared folder and read them back: one row a page."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    records = read_archives(spark, write_archives(pages, folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"))
    return records.select(page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          page_of(F.col("refers_to_id")).alias("refers_to"), "archive", "offset", "length")
