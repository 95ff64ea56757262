import base64
import collections
import hashlib
import io
import random
import zipfile

import pyarrow as pa
import pytest

from ledgerflow.llm import warc_zip
from ledgerflow.session import scratch_path

ROWS = [(1, "http://a/ b\r\nX: y", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "http://c", None), (4, "http://d", ""), (None, "http://e", "<p>é</p>"),
        (None, None, None), (7, "http://f", "x" * 3_000_000), (8, "u", "dup"), (8, "u", "dup"), (9, "http://g", "HTTP/1.1\r\n\r\nbody")]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, rk string, digest string")


def expected(rows, least=0):
    tops = {}
    for i, _, h in rows:
        h = (h or "").encode()
        tops[h] = max(tops.get(h, (False, 0)), (i is not None, i or 0))
    out, used = collections.Counter(), set()
    for i, _, h in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True):
        h = (h or "").encode()
        first = len(h) < least or h not in used
        used.add(h)
        top = tops[h][1] if tops[h][0] else None
        out[i, len(h), base64.b32encode(hashlib.sha1(h).digest()).decode(), "response" if first else "revisit", None if first else top] += 1
    return out


def test_round_trip(spark):
    got = warc_zip.round_trip(pages(spark, ROWS)).collect()
    assert collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == expected(ROWS)
    assert warc_zip.round_trip(pages(spark, ROWS).limit(0)).count() == 0


def test_small_payloads_are_all_responses(spark):
    folder = f"file://{scratch_path(spark, 'warc-small')}"
    manifest = warc_zip.write_archives(pages(spark, ROWS), folder, min_payload=4, package_records=3)
    got = warc_zip.read_archives(spark, manifest).collect()
    assert collections.Counter((r.record_type) for r in got) == collections.Counter(x[3] for x in expected(ROWS, 4).elements())
    assert sum(r.n_records for r in manifest.collect()) == len(ROWS) and manifest.count() >= 4
    whole = {r.payload for r in got if r.record_type == "response"}
    assert whole == {(h or "").encode() for _, _, h in ROWS}
    path = manifest.first().archive.removeprefix("file://").removeprefix("file:")
    with zipfile.ZipFile(path) as z:  # another reader agrees with ours
        assert z.testzip() is None and {i.compress_type for i in z.infolist()} == {zipfile.ZIP_STORED}
        assert z.read(warc_zip.WARC_MEMBER)[:2] == b"\x1f\x8b"


class Bytes:
    def __init__(self, data):
        self.data = data

    def size(self):
        return len(self.data)

    def read_at(self, n, at):
        return self.data[at:at + n]


def package(index=True, zip64=False, comment=b"", method=zipfile.ZIP_STORED, extra=0):
    body = io.BytesIO()
    records = [warc_zip.encode_record(f"urn:page:{i}:{i}", f"http://x/{i}", f"payload {i}".encode(), "1970-01-01T00:00:00Z") for i in range(5)]
    with zipfile.ZipFile(body, "w", method) as z:
        for i in range(extra):
            z.writestr(f"other/{i}", b"")
        with z.open(warc_zip.WARC_MEMBER, "w", force_zip64=zip64) as m:
            m.write(b"".join(records))
        if index:
            at, lines = 0, b""
            for i, r in enumerate(records):
                lines += f'urn:page:{i} {{"offset": "{at}", "length": "{len(r)}"}}\n'.encode()
                at += len(r)
            z.writestr(warc_zip.INDEX_MEMBER, lines)
        z.comment = comment
    return body.getvalue()


@pytest.mark.parametrize("kw", [{}, {"index": False}, {"zip64": True}, {"comment": b"PK\x05\x06 not the end" * 3}, {"extra": 70_000}])
def test_reads_packages_of_another_writer(kw):
    data = package(**kw)
    f = Bytes(data)
    plain = package(**kw | {"comment": b""})  # zipfile itself does not read a comment with an end signature
    assert {m.name: (m.header_at, m.size) for m in warc_zip.zip_members(f)} == {i.filename: (i.header_offset, i.file_size) for i in zipfile.ZipFile(io.BytesIO(plain)).infolist()}
    got = [warc_zip.decode_record(raw) for _, _, raw in warc_zip.read_records(f)]
    assert [r["payload"] for r in got] == [f"payload {i}".encode() for i in range(5)]


def test_zip64_sizes_and_offsets_beyond_4_gib():
    """A sparse file: a member that starts beyond 4 GiB."""
    import tempfile
    with tempfile.TemporaryFile() as raw:
        raw.seek((4 << 30) + 1000)
        with zipfile.ZipFile(raw, "w") as z:
            z.writestr("a", b"1")
            z.writestr(warc_zip.WARC_MEMBER, b"22")
        f = pa.PythonFile(raw, mode="r")
        members = {m.name: m for m in warc_zip.zip_members(f)}
        assert members[warc_zip.WARC_MEMBER].header_at > 4 << 30
        assert f.read_at(2, warc_zip.data_start(f, members[warc_zip.WARC_MEMBER])) == b"22"


def test_broken_packages():
    with pytest.raises(ValueError, match="compressed"):
        list(warc_zip.read_records(Bytes(package(method=zipfile.ZIP_DEFLATED))))
    for data in (b"", b"hello", package()[:-30], random.Random(0).randbytes(500)):
        with pytest.raises(ValueError):
            list(warc_zip.read_records(Bytes(data)))
