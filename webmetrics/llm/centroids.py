"""Centroid clustering over dictionary-encoded subvectors.

Vectors of integers ``floor(scale * x)`` are cut into blocks of a few dimensions. Once,
chunks of the table are encoded without loss: for each block the chunk's distinct
subvectors and for each vector their numbers (one or two bytes, as rounding leaves few
values). Chunks are rows of a table in the shared folder. In a round a task computes the
squared distance of each distinct subvector to each centroid once, and a vector's
distance is the sum over the blocks of what its codes name: no arithmetic on whole vectors.
A dictionary belongs to its chunk (as a Parquet dictionary to its row group): it is never
larger than the chunk, however many subvectors the whole table has, and no row is
shuffled. New centroids are componentwise floors of exact means: a chunk counts how often
each code occurs in each cluster and sends count x subvector summed by cluster.

All arithmetic is on integers (Python's where a long may not hold the distances), so results
don't depend on the order of rows or tasks.

Defined results: vectors that are null, hold a null or non-finite component, or have another
length than ``dims`` are left out; starting centroids are the vectors with the smallest
sha256 of "<seed>:<id>", null ids last, equal ids in order of their vectors; fewer rows than
centroids make fewer centroids; equal rows count each; a centroid without vectors stays;
ties go to the smaller number; an empty table gives no rows; sums beyond a long are the
largest long.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webmetrics.llm.blocks import written
from webmetrics.llm.frames import ship
from webmetrics.llm.vectors import SUMS, Sums, as_long, integers, largest, small_bound, summed, totals, usable

DIMS, CENTROIDS, ROUNDS, SCALE, SEED = 64, 16, 3, 64, 1
BLOCK_DIMS = 2
CHUNK_ROWS = 1 << 16
_STEP = 4096        # vectors whose distances are summed at once


def encode_chunk(x: np.ndarray, block: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct subvectors of each block of dimensions, and each vector's codes."""
    books, codes = [], []
    for a in range(0, x.shape[1], block):
        sub = x[:, a:a + block]
        if sub.dtype == object:
            seen: dict = {}
            code = np.array([seen.setdefault(tuple(r), len(seen)) for r in sub.tolist()])
            book = np.array(list(seen), object).reshape(len(seen), -1)
        else:
            book, code = np.unique(sub, axis=0, return_inverse=True)
        books.append(book)
        codes.append(code.ravel())
    kind = np.uint8 if max(map(len, books)) <= 1 << 8 else np.uint16 if max(map(len, books)) <= 1 << 16 else np.uint32
    return books, np.stack(codes).astype(kind)


def _stored(books: list[np.ndarray], codes: np.ndarray) -> dict:
    """A chunk's dictionaries and codes as Arrow values; integers beyond int64 as text."""
    big = any(b.dtype == object for b in books)
    flat = [str(v) for b in books for v in b.ravel().tolist()] if big else None
    raw = ",".join(flat).encode() if big else np.concatenate([b.ravel() for b in books]).astype(np.int64).tobytes()
    return {"sizes": [len(b) for b in books], "wide": big, "books": raw, "width": codes.itemsize, "codes": codes.tobytes()}


def _loaded(batch: pa.RecordBatch, i: int, dims: int, block: int) -> tuple[list[np.ndarray], np.ndarray]:
    sizes = batch.column("sizes")[i].as_py()
    raw = batch.column("books")[i].as_py()
    flat = np.array([int(v) for v in raw.split(b",")], object) if batch.column("wide")[i].as_py() else np.frombuffer(raw, np.int64)
    books, at = [], 0
    for k, n in enumerate(sizes):
        w = min(block, dims - k * block)
        books.append(flat[at:at + n * w].reshape(n, w))
        at += n * w
    kind = {1: np.uint8, 2: np.uint16, 4: np.uint32}[batch.column("width")[i].as_py()]
    return books, np.frombuffer(batch.column("codes")[i].as_buffer(), kind).reshape(len(sizes), -1)


class Chunks:
    """The kept vectors as dictionary-encoded chunks, a table in the shared folder."""

    def __init__(self, vectors: DataFrame, ident: str = "vec_id", vector: str = "embedding", carry=(), dims: int = DIMS,
                 scale: int = SCALE, block: int = BLOCK_DIMS, chunk_rows: int = CHUNK_ROWS):
        ship(vectors.sparkSession)
        self.ident, self.carry, self.dims, self.scale, self.block = ident, carry, dims, scale, block
        more = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)]
        v = F.col(f"`{vector}`").cast("array<double>").alias("v")
        self.rows = vectors.where(usable(vector)).select(F.col(f"`{ident}`").alias("id"), v, *more).where(F.size("v") == dims)
        self.fields = [f for f in self.rows.schema.fields if f.name != "v"]

        def chunk(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            sink = pa.BufferOutputStream()
            names = [n for n in t.column_names if n != "v"]
            with pa.ipc.new_stream(sink, t.select(names).schema) as w:
                w.write_table(t.select(names))
            one = _stored(*encode_chunk(integers(t["v"], dims, scale), block))
            return pa.RecordBatch.from_pydict({"rows": pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                                               "sizes": pa.array([one["sizes"]], pa.list_(pa.int32())), "wide": pa.array([one["wide"]]),
                                               "books": pa.array([one["books"]], pa.binary()), "width": pa.array([one["width"]], pa.int32()),
                                               "codes": pa.array([one["codes"]], pa.binary())})

        def run(batches):
            held, n = [], 0
            for batch in batches:
                while batch.num_rows:
                    part = batch.slice(0, chunk_rows - n)
                    batch = batch.slice(part.num_rows)
                    held.append(part)
                    n += part.num_rows
                    if n == chunk_rows:
                        yield chunk(held)
                        held, n = [], 0
            if held:
                yield chunk(held)

        kind = "rows binary, sizes array<int>, wide boolean, books binary, width int, codes binary"
        self.table = written(self.rows.mapInArrow(run, kind), "chunks")

    def start(self, centroids: int, seed: int) -> list[list[int]]:
        draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
        rows = self.rows.select("v", draw.alias("h"), "id").orderBy(F.col("h").asc_nulls_last(), "v").limit(centroids).collect()
        if not rows:
            return []
        return integers(pa.array([r["v"] for r in rows], pa.list_(pa.float64())), self.dims, self.scale).tolist()


def _centroids(c: list[list[int]]) -> np.ndarray:
    a = np.array(c, object)
    return a.astype(np.int64) if largest(a) < 1 << 62 else a


def assigned(books: list[np.ndarray], codes: np.ndarray, c: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid (first of equals) and squared distance of each vector of a chunk:
    distances of the distinct subvectors, summed by code."""
    exact = max(max(map(largest, books)), largest(c)) <= small_bound(c.shape[1])
    kind = np.int64 if exact else object
    tables = []
    for k, book in enumerate(books):
        diff = book.astype(kind)[:, None, :] - c[:, k * block:k * block + book.shape[1]].astype(kind)[None, :, :]
        tables.append((diff * diff).sum(axis=2))
    n = codes.shape[1]
    at, far = np.zeros(n, np.int64), np.zeros(n, kind)
    for a in range(0, n, _STEP):
        d = np.zeros((min(_STEP, n - a), len(c)), kind)
        for table, code in zip(tables, codes, strict=True):
            d += table[code[a:a + _STEP]]
        k = d.argmin(axis=1)
        at[a:a + _STEP], far[a:a + _STEP] = k, d[np.arange(len(d)), k]
    return at, far


def chunk_sums(books: list[np.ndarray], codes: np.ndarray, at: np.ndarray, n_centroids: int, sums: Sums) -> None:
    """Adds a chunk's vectors by cluster: occurrences of each code times its subvector."""
    per = np.bincount(at, minlength=n_centroids)
    found = np.flatnonzero(per)
    whole = [[] for _ in range(n_centroids)]
    for book, code in zip(books, codes, strict=True):
        times = np.bincount(at * len(book) + code, minlength=n_centroids * len(book)).reshape(n_centroids, len(book))
        exact = book.dtype != object and largest(book) * len(at) < 1 << 62
        total = (times[:, :, None] * book[None] if exact else times.astype(object)[:, :, None] * book.astype(object)[None]).sum(axis=1)
        for k in found:
            whole[k] += total[k].tolist()
    for k in found:
        old = sums.held.get((0, int(k)))
        new = [int(per[k]), whole[k]]
        sums.held[0, int(k)] = new if old is None else [old[0] + new[0], [a + b for a, b in zip(old[1], new[1], strict=True)]]


def train(chunks: Chunks, centroids: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> list[list[int]]:
    """The final centroids; a pass over the codes a round."""
    c = chunks.start(centroids, seed)
    dims, block = chunks.dims, chunks.block
    codes = chunks.table.select("sizes", "wide", "books", "width", "codes")
    for _ in range(rounds if c else 0):
        now = _centroids(c)

        def run(batches, now=now):
            sums = Sums()
            for batch in batches:
                for i in range(batch.num_rows):
                    books, code = _loaded(batch, i, dims, block)
                    chunk_sums(books, code, assigned(books, code, now, block)[0], len(now), sums)
            yield from sums.batches()

        found = totals(codes.mapInArrow(run, SUMS))
        c = [[t // got[0] for t in got[1:]] if (got := found.get((0, k))) else old for k, old in enumerate(c)]
    return c


def clustered(chunks: Chunks, c: list[list[int]]) -> DataFrame:
    """id, carried columns, cluster, distance."""
    names = [f.name for f in chunks.fields]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in chunks.fields)
    dims, block, now = chunks.dims, chunks.block, _centroids(c) if c else None

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                rows = pa.ipc.open_stream(batch.column("rows")[i].as_buffer()).read_all()
                at, far = assigned(*_loaded(batch, i, dims, block), now, block)
                out = rows.append_column("cluster", pa.array(at, pa.int32())).append_column("distance", as_long(far))
                yield from out.to_batches()

    out = chunks.table.mapInArrow(run, f"{kinds}, cluster int, distance long")
    return out.select(*[F.col(n).alias(x) for n, x in zip(names, [chunks.ident, *chunks.carry], strict=True)], "cluster", "distance")


def with_inertia(rows: DataFrame, c: list[list[int]]) -> DataFrame:
    """Adds cluster_inertia, inertia and centroid_sha256; a row per cluster is broadcast."""
    per = rows.groupBy("cluster").agg(summed("distance").alias("cluster_inertia"), F.sum(F.col("distance").cast("decimal(19,0)")).alias("d"))
    found = sorted(per.collect())
    total = min(sum(int(r["d"]) for r in found), (1 << 63) - 1)
    kind = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    data = [(r["cluster"], r["cluster_inertia"], total, hashlib.sha256(",".join(map(str, c[r["cluster"]])).encode()).hexdigest()) for r in found]
    return rows.join(F.broadcast(rows.sparkSession.createDataFrame(data, kind)), "cluster")


def query(spark, sf_dir: str) -> DataFrame:
    """op13: clusters of all ``embeddings`` of 64 components."""
    chunks = Chunks(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    c = train(chunks)
    out = with_inertia(written(clustered(chunks, c), "clusters"), c)
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
