"""Compression of vectors to codes: exact codebooks by limb-split matrix products.

A vector of integers ``floor(scale * x)`` is cut into parts, each part is replaced by the
number of the nearest entry of its codebook. Codebooks start as the parts of the first
vectors by id and are moved to the componentwise floor of the mean a fixed number of
times, as integers: results don't depend on the order of rows or tasks.

Squared distances are |x|^2 - 2 x.c + |c|^2. The products x.c are float64 matrix products
(BLAS), which are exact only below 2^53: both factors are therefore broken into limbs so
narrow that a product of two limbs, summed over the part, stays below 2^53. The limbs'
products are shifted and added as int64, and the first least distance wins, so that ties go
to the smaller number. Components too large for int64 distances (about 2^27) take the
same steps with Python integers.

Each round is one pass over the table: tasks assign their vectors and send sums by entry
(entries x components, in 32-bit limbs); the driver holds the codebooks only (256 entries of
``dims`` integers), which go to the tasks with the function.

Defined results: vectors that are null or hold a null or non-finite component are left out;
so are those whose length differs from that of the first kept one by id (a length that the
parts don't divide is cut as evenly as can be); null ids come after all others, equal ids in
order of their vectors; equal rows are coded each by itself; fewer rows than entries make a
smaller codebook; an empty table gives no rows; errors beyond a long are the largest long.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webmetrics.llm.blocks import written
from webmetrics.llm.frames import ship
from webmetrics.llm.vectors import SUMS, Sums, as_long, integers, largest, small_bound, summed, totals, usable

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
ROWS = 4096     # vectors multiplied at once


def _split(x: np.ndarray, width: int) -> list[np.ndarray]:
    """Limbs of ``width`` bits as float64, least first; the last one is signed."""
    out = []
    while largest(x) > 1 << width:
        out.append((x & ((1 << width) - 1)).astype(np.float64))
        x = x >> width
    return [*out, x.astype(np.float64)]


def products(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """x @ c.T of int64 matrices, exactly, by float64 products of limbs."""
    width = (53 - x.shape[1].bit_length()) // 2
    out = np.zeros((len(x), len(c)), np.int64)
    others = _split(c, width)
    for i, a in enumerate(_split(x, width)):
        for j, b in enumerate(others):
            out += (a @ b.T).astype(np.int64) << (width * (i + j))
    return out


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first nearest entry of each row and its squared distance."""
    if max(largest(x), largest(c)) <= small_bound(x.shape[1]):
        c = c.astype(np.int64)
        x = x.astype(np.int64)
        d = (x * x).sum(axis=1)[:, None] - 2 * products(x, c) + (c * c).sum(axis=1)[None, :]
        k = d.argmin(axis=1)
        return k, d[np.arange(len(x)), k]
    at, far = np.zeros(len(x), np.int64), np.zeros(len(x), object)
    c = c.astype(object)
    for i, row in enumerate(x.astype(object)):
        d = ((c - row) ** 2).sum(axis=1).tolist()
        at[i] = d.index(min(d))
        far[i] = d[at[i]]
    return at, far


@dataclass(frozen=True)
class Codebooks:
    """books[part]: the entries of that part; cuts: where the parts start and end."""
    books: list
    cuts: list
    scale: int

    @property
    def dims(self) -> int:
        return self.cuts[-1]

    def digest(self) -> str:
        flat = ",".join(str(v) for b in self.books for e in b for v in e)
        return hashlib.sha256(flat.encode()).hexdigest()


def _kept(vectors: DataFrame, ident: str, vector: str, dims: int | None = None, carry=()) -> DataFrame:
    ship(vectors.sparkSession)
    v = F.col(f"`{vector}`").cast("array<double>").alias("v")
    more = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)]
    rows = vectors.where(usable(vector)).select(F.col(f"`{ident}`").alias("id"), v, *more)
    return rows if dims is None else rows.where(F.size("v") == dims)


def _pieces(batches, books: Codebooks):
    """Batches of at most ROWS vectors with their integers."""
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            piece = batch.slice(a, ROWS)
            yield piece, integers(piece.column("v"), books.dims, books.scale)


def train(vectors: DataFrame, ident: str = "vec_id", vector: str = "embedding", scale: int = SCALE,
          parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """The codebooks of the table; a pass over it for the start and one a round."""
    first = F.col("id").asc_nulls_last(), F.col("v").asc()
    one = _kept(vectors, ident, vector).orderBy(*first).select(F.size("v").alias("n")).first()
    dims = one["n"] if one else 0
    cuts = [dims * k // parts for k in range(parts + 1)]
    rows = _kept(vectors, ident, vector, dims)
    start = rows.orderBy(*first).limit(entries).select("v").collect()
    x = integers(pa.array([r["v"] for r in start], pa.list_(pa.float64())), dims, scale) if start and dims else np.zeros((len(start), dims), np.int64)
    books = Codebooks([x[:, a:b].tolist() for a, b in zip(cuts, cuts[1:])], cuts, scale)
    if not start or not dims:
        return books
    for _ in range(rounds):
        found = totals(rows.select("v").mapInArrow(_summing(books), SUMS))
        books = Codebooks([[_moved(e, found.get((p, k))) for k, e in enumerate(b)] for p, b in enumerate(books.books)], cuts, scale)
    return books


def _moved(entry: list[int], found: list[int] | None) -> list[int]:
    """The floor of the mean of what was assigned to an entry; unused ones stay."""
    return [t // found[0] for t in found[1:]] if found else entry


def _arrays(books: Codebooks) -> list[np.ndarray]:
    """Entries as arrays: int64 if they fit."""
    out = []
    for b, low, high in zip(books.books, books.cuts, books.cuts[1:]):
        a = np.array(b, object).reshape(len(b), high - low)
        out.append(a.astype(np.int64) if largest(a) < 1 << 62 else a)
    return out


def _summing(books: Codebooks):
    def run(batches):
        sums, held = Sums(), _arrays(books)
        for _, x in _pieces(batches, books):
            for p, (a, b) in enumerate(zip(books.cuts, books.cuts[1:])):
                if b > a:
                    sums.add(p, nearest(x[:, a:b], held[p])[0], x[:, a:b])
        yield from sums.batches()
    return run


def encode(vectors: DataFrame, books: Codebooks, ident: str = "vec_id", vector: str = "embedding", carry=()) -> DataFrame:
    """id, carried columns, code (two hex digits a part for up to 256 entries) and error."""
    rows = _kept(vectors, ident, vector, books.dims, carry)
    names = [f.name for f in rows.schema.fields if f.name != "v"]
    kinds = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)
    digits = max(2, len(f"{max(len(b) for b in books.books) - 1:x}")) if books.books else 2

    def run(batches):
        held = _arrays(books)
        for piece, x in _pieces(batches, books):
            codes, error = [], np.zeros(len(x), np.int64)
            for p, (a, b) in enumerate(zip(books.cuts, books.cuts[1:])):
                k, d = nearest(x[:, a:b], held[p]) if b > a else (np.zeros(len(x), np.int64),) * 2
                codes.append([f"{v:0{digits}x}" for v in k.tolist()])
                error = error.astype(object) + d if d.dtype == object or largest(error) + largest(d) >= 1 << 62 else error + d
            code = ["".join(c) for c in zip(*codes, strict=True)]
            yield pa.RecordBatch.from_pydict({n: piece.column(n) for n in names} | {"code": pa.array(code, pa.string()), "error": as_long(error)})

    out = rows.mapInArrow(run, f"{kinds}, code string, error long")
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, [ident, *carry], strict=True)], "code", "error")


def decoded(code: str, books: Codebooks) -> list[int]:
    """The integers that a code stands for."""
    n = len(code) // len(books.books)
    return [v for p, b in enumerate(books.books) for v in b[int(code[p * n:(p + 1) * n], 16)]]


def with_error_by(codes: DataFrame, label: str) -> DataFrame:
    """Adds label_error, the error summed over equal labels (null is a label)."""
    per = codes.groupBy(F.col(f"`{label}`").alias("~label")).agg(summed("error").alias("label_error"))
    return codes.join(per, F.col(f"`{label}`").eqNullSafe(F.col("~label"))).drop("~label")


def query(spark, sf_dir: str) -> DataFrame:
    """op12: codes of all ``embeddings``."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    books = train(vectors)
    codes = written(encode(vectors, books, carry=["label"]), "codes")
    out = with_error_by(codes, "label")
    return out.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
