"""WARC archives in ZIP packages: writing, and reading by ranges without extraction.

A package (as of WACZ) is a ZIP file with two stored members: ``archive/data.warc.gz``,
one gzip member per record, and ``indexes/index.cdxj``, a line per record with its offset
and length. The reader opens a package through a range source, parses the end record,
the ZIP64 locator and directory where present, and the central directory, finds the
stored members, reads the index member and then each record's own range. Nothing is
unpacked to disk, and no member is read whole but the index.

Packages are written and read by tasks through Arrow's file systems, in the shared
folder. A package is written under a task's own name and then renamed, so a task that
runs again does no harm. Each holds about ``package_bytes`` of payload.

Payloads of ``min_bytes`` or more that occur again are written as revisit records that
refer to the record with the largest page id. The largest id of each digest comes from a
pre-aggregated group; documents are joined by id, not by digest, so a payload that a
third of all pages share meets in no task.

Defined results: null html: an empty payload; pages with equal ids: each is written, and
those whose id is the largest of their digest are all responses; a null page id is below
all others; null urls: an empty target; an empty table gives no packages and no rows;
other columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webmetrics.llm.blocks import scratch, written
from webmetrics.llm.frames import ship

PACKAGE_BYTES = 16 << 20
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
RECORDS = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "target string, payload binary")
_MAX32 = 0xFFFFFFFF


# --- writing ---------------------------------------------------------------

def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url, payload: bytes, refers_to) -> tuple[bytes, dict]:
    """One gzipped WARC record, and what its index line says."""
    kind = "response" if refers_to is None else "revisit"
    block = payload if refers_to is None else b""
    digest = digest_of(payload)
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {_line(url)}", f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(raw, 1, mtime=0), {"id": page_id, "type": kind}


def _line(s) -> str:
    return "" if s is None else "".join(" " if c in "\r\n" else c for c in s)


class ZipWriter:
    """Stored members, one after the other, with ZIP64 fields where sizes ask for it."""

    def __init__(self, out, zip64: bool = False):
        self.out, self.at, self.members, self.zip64 = out, 0, [], zip64

    def add(self, name: str, parts: list[bytes]) -> None:
        crc, size = 0, sum(map(len, parts))
        for p in parts:
            crc = zlib.crc32(p, crc)
        big = self.zip64 or size >= _MAX32
        extra = struct.pack("<HHQQ", 1, 16, size, size) if big else b""
        s = _MAX32 if big else size
        raw = name.encode()
        head = struct.pack("<IHHHHHIIIHH", 0x04034B50, 45 if big else 20, 0x800, 0, 0, 0x21, crc, s, s, len(raw), len(extra))
        self.members.append((raw, crc, size, self.at))
        for p in (head, raw, extra, *parts):
            self._put(p)

    def close(self) -> None:
        start = self.at
        for raw, crc, size, at in self.members:
            big = self.zip64 or size >= _MAX32 or at >= _MAX32
            extra = struct.pack("<HHQQQ", 1, 24, size, size, at) if big else b""
            s, o = (_MAX32, _MAX32) if big else (size, at)
            self._put(struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45 if big else 20, 0x800, 0, 0, 0x21,
                                  crc, s, s, len(raw), len(extra), 0, 0, 0, 0, o) + raw + extra)
        size, n, end = self.at - start, len(self.members), self.at
        big = self.zip64 or start >= _MAX32 or size >= _MAX32 or n >= 0xFFFF
        if big:
            self._put(struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, n, n, size, start))
            self._put(struct.pack("<IIQI", 0x07064B50, 0, end, 1))
        n, size, start = (0xFFFF, _MAX32, _MAX32) if big else (n, size, start)
        self._put(struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, n, n, size, start, 0))

    def _put(self, b: bytes) -> None:
        self.out.write(b)
        self.at += len(b)


def write_package(out, rows, zip64: bool = False) -> None:
    """rows: (page_id, url, payload, refers_to)."""
    parts, lines, at = [], [], 0
    for page_id, url, payload, refers in rows:
        raw, entry = record(page_id, url, payload, refers)
        lines.append(json.dumps(entry | {"offset": at, "length": len(raw)}) + "\n")
        parts.append(raw)
        at += len(raw)
    z = ZipWriter(out, zip64)
    z.add(DATA, parts)
    z.add(INDEX, ["".join(lines).encode()])
    z.close()


def write_archives(pages: DataFrame, folder: str, ident: str = "page_id", url: str = "url", html: str = "html",
                   min_bytes: int = 0, package_bytes: int = PACKAGE_BYTES, zip64: bool = False) -> DataFrame:
    """Writes the pages as packages below ``folder``; their paths, one row each."""
    ship(pages.sparkSession)
    p = pages.select(F.col(f"`{ident}`").cast("long").alias("id"), F.col(f"`{url}`").alias("url"),
                     F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("html"))
    digest = F.sha1(F.col("html").cast("binary"))
    ids = p.where(F.octet_length("html") >= min_bytes).select("id", digest.alias("d"))
    last = ids.groupBy("d").agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    refers = ids.join(last, "d").where("not (id <=> keep)").select(F.col("id").alias("rid"), "keep", F.col("d").alias("rd")).distinct()
    all_ = p.withColumn("d", digest).join(refers, F.expr("id <=> rid and d = rd"), "left")
    rows = all_.select("id", "url", "html", F.col("keep").alias("refers_to"))

    def run(batches):
        from pyspark import TaskContext
        ctx = TaskContext.get()
        held, size, n, paths = [], 0, 0, []

        def flush():
            nonlocal held, size, n
            name = f"{folder}/part-{ctx.partitionId():06d}-{n:04d}.wacz"
            fs, path = pafs.FileSystem.from_uri(name)
            with fs.open_output_stream(f"{path}.{ctx.taskAttemptId()}") as out:
                write_package(out, held, zip64)
            fs.move(f"{path}.{ctx.taskAttemptId()}", path)
            paths.append(name)
            held, size, n = [], 0, n + 1

        for batch in batches:
            for i, u, h, r in zip(*[batch.column(c) for c in ("id", "url", "html", "refers_to")], strict=True):
                payload = h.as_buffer().to_pybytes()
                held.append((i.as_py(), u.as_py(), payload, r.as_py()))
                size += len(payload)
                if size >= package_bytes:
                    flush()
        if held:
            flush()
        yield pa.RecordBatch.from_pydict({"path": pa.array(paths, pa.string())})

    spark = pages.sparkSession
    uri = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    folder = uri
    fs, path = pafs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    return written(rows.mapInArrow(run, "path string"), "packages")


# --- reading ---------------------------------------------------------------

class Ranges:
    """Byte ranges of a file, through Arrow's file systems."""

    def __init__(self, uri: str):
        fs, path = pafs.FileSystem.from_uri(uri)
        self.file = fs.open_input_file(path)
        self.size = self.file.size()

    def read(self, at: int, size: int) -> bytes:
        if at < 0 or size < 0 or at + size > self.size:
            raise ValueError(f"range {at}+{size} is outside of {self.size} bytes")
        self.file.seek(at)
        return self.file.read(size)


def directory(src) -> dict[str, tuple[int, int, int]]:
    """Members by name: (compression method, offset of the data, stored size)."""
    tail = src.read(max(0, src.size - 65557), min(src.size, 65557))
    end = tail.rfind(b"PK\5\6")
    if end < 0:
        raise ValueError("no end of central directory")
    n, size, start = struct.unpack("<HII", tail[end + 10:end + 20])
    if 0xFFFF in (n,) or _MAX32 in (size, start):
        at = src.size - len(tail) + end - 20
        sig, _, where, _ = struct.unpack("<IIQI", src.read(at, 20))
        if sig != 0x07064B50:
            raise ValueError("no ZIP64 locator")
        sig, *_, n, size, start = struct.unpack("<IQHHIIQQQQ", src.read(where, 56))
        if sig != 0x06064B50:
            raise ValueError("no ZIP64 end of central directory")
    raw, at, out = src.read(start, size), 0, {}
    for _ in range(n):
        sig, _, _, _, method, _, _, _, comp, full, ln, le, lc, _, _, _, head = struct.unpack("<IHHHHHHIIIHHHHHII", raw[at:at + 46])
        if sig != 0x02014B50:
            raise ValueError("broken central directory")
        name = raw[at + 46:at + 46 + ln].decode()
        extra = raw[at + 46 + ln:at + 46 + ln + le]
        while len(extra) >= 4:
            tag, length = struct.unpack("<HH", extra[:4])
            if tag == 1:
                wide = list(struct.unpack(f"<{length // 8}Q", extra[4:4 + length // 8 * 8]))
                full = wide.pop(0) if full == _MAX32 else full
                comp = wide.pop(0) if comp == _MAX32 else comp
                head = wide.pop(0) if head == _MAX32 else head
            extra = extra[4 + length:]
        local = struct.unpack("<IHHHHHIIIHH", src.read(head, 30))
        out[name] = (method, head + 30 + local[9] + local[10], comp)
        at += 46 + ln + le + lc
    return out


def read_package(src):
    """Parsed records of a package, each read by its own range."""
    members = directory(src)
    for name in (DATA, INDEX):
        if members[name][0] != 0:
            raise ValueError(f"{name} is not stored")
    base, size = members[DATA][1:]
    for line in src.read(*members[INDEX][1:]).splitlines():
        e = json.loads(line)
        if e["offset"] + e["length"] > size:
            raise ValueError("a record leaves its member")
        yield parse(gzip.decompress(src.read(base + e["offset"], e["length"])))


def parse(raw: bytes) -> dict:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    h = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[:int(h["Content-Length"])]

    def page(s):
        s = s.removeprefix("<urn:page:").removesuffix(">")
        return int(s) if s else None

    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
    if h["WARC-Type"] == "response" and digest_of(block) != digest:
        raise ValueError(f"payload of {h['WARC-Record-ID']} does not fit its digest")
    return {"page_id": page(h["WARC-Record-ID"]), "payload_bytes": int(h["X-Payload-Length"]), "payload_digest": digest,
            "record_type": h["WARC-Type"], "refers_to": page(h["WARC-Refers-To"]) if "WARC-Refers-To" in h else None,
            "target": h["WARC-Target-URI"], "payload": block}


def read_archives(paths: DataFrame, path: str = "path") -> DataFrame:
    """Records of the packages: one row each; revisits have an empty payload."""
    ship(paths.sparkSession)

    def run(batches):
        names = [x.split()[0] for x in RECORDS.split(", ")]
        kinds = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                           ("record_type", pa.string()), ("refers_to", pa.int64()), ("target", pa.string()), ("payload", pa.binary())])
        for batch in batches:
            for p in batch.column("path").to_pylist():
                held, size = [], 0
                for r in read_package(Ranges(p)):
                    held.append(r)
                    size += len(r["payload"])
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(held, kinds)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, kinds).select(names)

    p = paths.select(F.col(path).alias("path"))
    return p.repartition(F.col("path")).mapInArrow(run, RECORDS)


def query(spark, sf_dir: str) -> DataFrame:
    """op3: ``pages`` through packages and back."""
    folder = scratch(spark, "wacz")
    paths = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read_archives(paths).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
