"""Vectors of integers, exact whatever their size.

Components become ``floor(scale * x)``. Vectors whose components are small enough for
64-bit arithmetic are int64 arrays; others are arrays of Python integers, which numpy
computes with by the same operators. Sums over many tasks travel in limbs of 32 bits, so
that no addition of longs can overflow.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_LONG = (1 << 63) - 1
#: Sums of vectors by group on their way from the tasks: pos -1 holds the number of vectors.
SUMS = "part int, entry int, pos int, limb int, v long"


def usable(vector: str) -> Column:
    """Neither null nor with a null or non-finite component."""
    c = F.col(f"`{vector}`").cast("array<double>")
    return c.isNotNull() & F.coalesce(F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def integers(column, dims: int, scale: int) -> np.ndarray:
    """floor(scale * x) of the lists of ``dims`` doubles, a row each; Python integers if one is beyond 2^62."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not dims:
        return np.zeros((len(column), 0), np.int64)
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    big = np.abs(x) >= float(1 << 62) / scale
    if not big.any():
        return np.floor(x * scale).astype(np.int64).reshape(-1, dims)
    out = np.floor(np.where(big, 0, x) * scale).astype(np.int64).astype(object)
    out[big] = [int(v) * scale for v in x[big]]      # doubles of that size are whole
    return out.reshape(-1, dims)


def small_bound(dims: int) -> int:
    """Up to this size of components, squared distances of ``dims`` components fit a long."""
    return 1 << ((62 - max(dims, 1).bit_length()) // 2 - 1)


def largest(x: np.ndarray) -> int:
    return max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0


def _limbs(total: int) -> list[int]:
    """A sum as 32-bit limbs, least first; the last keeps the sign."""
    out = []
    while not -(1 << 31) <= total < 1 << 31:
        out.append(total & 0xFFFFFFFF)
        total >>= 32
    return [*out, total]


class Sums:
    """Sums and numbers of the vectors of each (part, entry) that a task has seen."""

    def __init__(self):
        self.held: dict[tuple[int, int], list] = {}

    def add(self, part: int, entry: np.ndarray, x: np.ndarray) -> None:
        order = np.argsort(entry, kind="stable")
        e = entry[order]
        first = np.flatnonzero(np.concatenate([[True], e[1:] != e[:-1]])) if len(e) else []
        if not len(first):
            return
        sums = np.add.reduceat(x[order].astype(object) if largest(x) * len(x) >= MAX_LONG else x[order], first, axis=0)
        for k, n, s in zip(e[first].tolist(), np.diff(np.append(first, len(e))).tolist(), sums.tolist(), strict=True):
            old = self.held.get((part, k))
            self.held[part, k] = [n, s] if old is None else [old[0] + n, [a + b for a, b in zip(old[1], s, strict=True)]]

    def batches(self):
        rows = []
        for (part, entry), (n, s) in self.held.items():
            rows += [(part, entry, pos, limb, v) for pos, t in enumerate([n, *s], -1) for limb, v in enumerate(_limbs(t))]
        names = [x.split()[0] for x in SUMS.split(", ")]
        for a in range(0, len(rows), 1 << 16):
            cols = zip(*rows[a:a + (1 << 16)], strict=True)
            kinds = [pa.int32()] * 4 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)


def totals(sums: DataFrame) -> dict[tuple[int, int], list[int]]:
    """{(part, entry): [number, sum of each component]} of the tasks' rows of SUMS. The
    result has a row per part, entry and limb, whatever the number of vectors."""
    rows = sums.groupBy("part", "entry", "pos", "limb").agg(F.sum("v").alias("v")).collect()
    out: dict[tuple[int, int], dict[int, int]] = {}
    for r in rows:
        t = out.setdefault((r["part"], r["entry"]), {})
        t[r["pos"]] = t.get(r["pos"], 0) + (r["v"] << 32 * r["limb"])
    return {k: [t[i] for i in range(-1, len(t) - 1)] for k, t in out.items()}


def as_long(values) -> pa.Array:
    """Exact sums as longs; beyond a long, the largest long."""
    if isinstance(values, np.ndarray) and values.dtype == np.int64:
        return pa.array(values)
    return pa.array([min(int(v), MAX_LONG) for v in values], pa.int64())


def summed(c: str) -> Column:
    """Sum of longs, at most the largest long."""
    total = F.sum(F.col(c).cast("decimal(19,0)"))
    return F.least(total, F.lit(MAX_LONG).cast("decimal(38,0)")).cast("long")
