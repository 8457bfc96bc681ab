"""Exact substring removal over bytes by a blockwise suffix sort with a difference cover.

A suffix here is compared by its first ``length`` bytes (200), as only equality
to that depth matters. The construction follows the difference-cover scheme:

1. *Cover sample.* Positions of a document whose number modulo v lies in a
   difference cover D are sampled (v = 91, ten residues: 11 % of all bytes).
   For any two positions i, j some shift d < v brings both i+d and j+d into
   the sample, so equal ``length``-byte strings always contain an equal pair
   of sample strings of length-v+1 bytes. These are sorted bucket by bucket;
   the rank of each is kept as one bit: unique, or tied with another.
2. *Suffix buckets.* A suffix that reaches no tied sample string within v bytes
   can't be equal to another to ``length`` bytes. The rest are dealt into
   buckets by their fingerprint and sorted a group of buckets at a time, one
   pass over the blocks per group, which bounds disk and memory.
3. Bytes covered by a suffix with an equal go.

Strings are ordered by 64-bit fingerprints instead of byte by byte, which groups
equal strings just as well. Two different strings share one with probability
2^-64 per pair.

Defined results: a null text counts as empty; an empty or shorter text keeps
all bytes; equal rows (also with one id) are different documents, each other's
copies; a null id is returned as it is; an empty table gives no rows; columns
other than the id, the text and those carried are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webmetrics.llm import blocks as B
from webmetrics.llm.words import Texts, byte_windows, covered, runs

#: Perfect difference sets (every nonzero residue is a difference exactly once).
COVERS = {
    1: (0,),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    31: (0, 1, 3, 8, 12, 18),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
    91: (0, 1, 3, 9, 27, 49, 56, 61, 77, 81),
}
PASSES = 3


def cover_for(length: int) -> tuple[int, tuple[int, ...]]:
    v = max(x for x in COVERS if x == 1 or 2 * x <= length)
    return v, COVERS[v]


def remove_repeats(docs: DataFrame, ident: str = "doc_id", text: str = "text", length: int = 200,
                   passes: int = PASSES, block_bytes: int = B.BLOCK_BYTES) -> DataFrame:
    """One row per document: id, n_bytes, spans (removed byte ranges), kept (binary)."""
    if length < 1:
        raise ValueError("length must be positive")
    v, cover = cover_for(length)
    depth = length - v + 1
    table = B.Blocks(docs, ident, text, block_bytes=block_bytes)
    nb = table.n_buckets

    def sample(block, rows, _):
        t = Texts(rows["text"])
        keys, _, twice = _distinct(byte_windows(t.data, _sampled(t, v, cover, depth), depth))
        return _rows(block, keys, twice, nb)

    tied = table.answered(table.sent(sample), B.repeated, 0)

    def candidates(rows, got):
        t = Texts(rows["text"])
        pos = _sampled(t, v, cover, depth)
        keys, back, _ = _distinct(byte_windows(t.data, pos, depth))
        pos = pos[B.gathered(got.get(0, {}), B.bucket_cuts(keys, nb))[back]]
        return t, _suffixes(t, pos, v, length)

    answers = tied
    for g in range(passes):
        low, high = _range(g, passes)

        def suffixes(block, rows, got, low=low, high=high, g=g):
            t, starts = candidates(rows, got)
            keys, _, twice = _distinct(_between(byte_windows(t.data, starts, length), low, high))
            return _rows(block, keys, twice, passes * nb)

        answers = answers.unionByName(table.answered(table.sent(suffixes, tied), B.repeated, g + 1))

    def finish(rows, got):
        t, starts = candidates(rows, got)
        h = byte_windows(t.data, starts, length)
        keys, back, _ = _distinct(h)
        bits = {k: x for n, part in got.items() if n for k, x in part.items()}
        gone = covered(len(t.data), starts[B.gathered(bits, B.bucket_cuts(keys, passes * nb))[back]], length)
        spans, kept = [], []
        for i in range(len(t)):
            a, b = t.offsets[i], t.offsets[i + 1]
            lo, hi = runs(gone[a:b])
            spans.append([{"start": int(x), "end": int(y)} for x, y in zip(lo, hi, strict=True)])
            kept.append(t.data[a:b][~gone[a:b]].tobytes())
        return pa.table({"id": rows["id"], "n_bytes": pa.array(np.diff(t.offsets), pa.int64()),
                         "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                         "kept": pa.array(kept, pa.binary())})

    kind = table.fields["id"].simpleString()
    out = table.finished(finish, f"id {kind}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary", answers)
    return out.withColumnRenamed("id", ident)


def query(spark, sf_dir: str) -> DataFrame:
    """op1: 200-byte strings over ``documents``; digest of what stays."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    r = remove_repeats(docs)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return r.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                    F.sha2("kept", 256).alias("kept_sha256"))


def _sampled(t: Texts, v: int, cover, depth: int) -> np.ndarray:
    """Sample positions, counted from each text's start, with room for a sample string."""
    d, out = np.asarray(cover), []
    for a, b in zip(t.offsets[:-1].tolist(), t.offsets[1:].tolist(), strict=True):
        room = b - a - depth
        if room >= 0:
            p = (np.arange(0, room + 1, v)[:, None] + d).ravel()
            out.append(p[:np.searchsorted(p, room, side="right")] + a)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _suffixes(t: Texts, tied: np.ndarray, v: int, length: int) -> np.ndarray:
    """Positions with room for ``length`` bytes that reach a tied sample string within v bytes."""
    first = t.offsets[np.searchsorted(t.offsets, tied, side="right") - 1]
    last = t.offsets[np.searchsorted(t.offsets, tied, side="right")] - length
    a, b = np.maximum(tied - v + 1, first), np.minimum(tied, last) + 1
    ok = a < b
    near = np.zeros(len(t.data) + 1, np.int32)
    np.add.at(near, a[ok], 1)
    np.add.at(near, b[ok], -1)
    return np.flatnonzero(np.cumsum(near[:-1]) > 0)


def _distinct(h: np.ndarray):
    keys, back, n = np.unique(h, return_inverse=True, return_counts=True)
    return keys, back, n > 1


def _range(g: int, n: int) -> tuple[int, int]:
    return (1 << 64) * g // n, (1 << 64) * (g + 1) // n - 1


def _between(h: np.ndarray, low: int, high: int) -> np.ndarray:
    return h[(h >= np.uint64(low)) & (h <= np.uint64(high))]


def _rows(block: int, keys: np.ndarray, twice: np.ndarray, n_buckets: int):
    cut = B.bucket_cuts(keys, n_buckets)
    return [(k, block, B.pack(keys[a:b], twice[a:b]))
            for k, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a]
