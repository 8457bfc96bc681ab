"""Packages: round trip, ZIP64, Python's zipfile as the judge, page revisits."""

import gzip
import hashlib
import io
import random
import zipfile

import pytest

from webmetrics.llm import warc


class Memory:
    def __init__(self, data):
        self.data, self.size, self.got = data, len(data), 0

    def read(self, at, size):
        assert at >= 0 and at + size <= self.size
        self.got += size
        return self.data[at:at + size]


@pytest.mark.parametrize("zip64", [False, True])
def test_package_round_trip(zip64):
    r = random.Random(1)
    rows = [(i, f"http://x/{i}\r\nEvil: 1", r.randbytes(r.randint(0, 3000)), 7 if i == 3 else None) for i in range(20)]
    out = io.BytesIO()
    warc.write_package(out, rows, zip64)
    z = zipfile.ZipFile(io.BytesIO(out.getvalue()))
    assert z.testzip() is None and z.namelist() == [warc.DATA, warc.INDEX]
    assert {x.compress_type for x in z.infolist()} == {zipfile.ZIP_STORED}
    assert gzip.decompress(z.read(warc.DATA)).count(b"WARC/1.1\r\n") == 20
    got = list(warc.read_package(Memory(out.getvalue())))
    for (i, _, payload, ref), g in zip(rows, got, strict=True):
        assert (g["page_id"], g["refers_to"], g["payload_bytes"]) == (i, ref, len(payload))
        assert g["payload"] == (b"" if ref else payload) and g["record_type"] == ("revisit" if ref else "response")


def test_reads_foreign_zips_and_refuses_broken_ones():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.comment = b"hello"
        for n in ("a", "b/ü"):
            with z.open(n, "w", force_zip64=True) as f:
                f.write(n.encode() * 5)
    src = Memory(out.getvalue())
    d = warc.directory(src)
    assert {n: src.read(o, s) for n, (_, o, s) in d.items()} == {"a": b"aaaaa", "b/ü": "b/ü".encode() * 5}
    with pytest.raises(ValueError):
        warc.directory(Memory(b"nothing"))
    broken = io.BytesIO()
    warc.write_package(broken, [(1, "u", b"payload", None)])
    with pytest.raises(Exception):
        list(warc.read_package(Memory(broken.getvalue()[:-30])))


def expected(rows, least=0):
    last = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= least:
            last[b] = max(last.get(b, -1), -1 if i is None else i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        keep = last.get(b, -1)
        ref = keep if keep != (-1 if i is None else i) and len(b) >= least else None
        out.append((i, len(b), warc.digest_of(b), "response" if ref is None else "revisit", ref))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 4])
def test_pages_with_nulls_copies_and_long_payloads(spark, tmp_path, least):
    rows = [(1, "u", "same é"), (2, None, "same é"), (9, "u", "same é"), (3, "u", None), (4, "u", ""), (5, "u", "x" * 300_000),
            (None, "u", "same é"), (6, "u", "abc"), (7, "v", "abc"), (9, "u", "same é")]
    pages = spark.createDataFrame([(i, u, h, "p", 1) for i, u, h in rows], "page_id long, url string, html string, payload string, id int")
    paths = warc.write_archives(pages, str(tmp_path / "w"), min_bytes=least, package_bytes=1000)
    got = warc.read_archives(paths).collect()
    assert sorted(((r[0], r[1], r[2], r[3], r[4]) for r in got), key=repr) == expected(rows, least)
    assert {r["payload"] for r in got if r["record_type"] == "response" and r["payload_bytes"] == 7} == {"same é".encode()}


def test_whole_table_and_empty(spark, tmp_path):
    from tests.conftest import SF_SMALL
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted((tuple(r) for r in warc.query(spark, SF_SMALL).collect()), key=repr) == expected(rows)
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(none, str(tmp_path / "none"))).count() == 0
    assert hashlib.sha1(b"").digest()
