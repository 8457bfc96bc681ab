"""Vectorised byte, word and window fingerprints over Arrow text columns.

All functions work on the UTF-8 bytes of whole texts. Fingerprints have 64 bits and are not
linear in the text, so that no pair of different texts shares one by construction (sums
of powers would: modulo 2^64 those of a Thue-Morse word and its complement are equal):

* a word up to ``SHORT`` bytes is read eight bytes at a time, each mixed with what came
  before; a longer one is hashed by BLAKE2b;
* a window of words is put together from windows of 1, 2, 4, ... words, mixed at each step;
* a byte window is a polynomial over the mixed eight-byte strings at its positions, from
  prefix sums, so that any window costs the same.

Memory is bounded by working through a batch in pieces.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20          # positions hashed at once
SHORT = 64               # bytes of a word that is hashed eight bytes at a time
_STEP = 1 << 15          # words whose windows are hashed at once
SLICE_BYTES = 4 << 20    # text handled at once in a map task
_LONG = 1 << 16          # a longer range is hashed piece by piece
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15   # odd, 5 modulo 8

#: Separator tables by byte value (True: not part of a word).
SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NOT_ALNUM = np.zeros(256, bool)      # what [^\x00-\x2F\x3A-\x60\x7B-\x7F] leaves out
NOT_ALNUM[0x00:0x30] = NOT_ALNUM[0x3A:0x61] = NOT_ALNUM[0x7B:0x80] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h ^= h >> _U(33)
    h *= _U(0xC4CEB9FE1A85EC53)
    h ^= h >> _U(33)
    return h


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


_N = PIECE + _LONG + 1
_POW: dict[str, np.ndarray] = {}


def _tables():
    if not _POW:
        _POW["p"] = _powers(_BASE, _N)
        _POW["i"] = _powers(pow(_BASE, -1, 1 << 64), _N)
    return _POW["p"], _POW["i"]


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position, as integers; zeros follow the last byte."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data),), "<u8", padded, strides=(1,))


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Fingerprints of pairs."""
    return mix(a * _U(_BASE) + b)


def _chains(h: np.ndarray, k: int) -> np.ndarray:
    """Fingerprints of h[i:i+k] for every i, put together from runs of 1, 2, 4, ..."""
    out, used, power, size = None, 0, h, 1
    n = len(h) - k + 1
    while True:
        if k & size:
            out = power[:n] if out is None else _joined(out, power[used:used + n])
            used += size
        if used == k:
            return out
        power = _joined(power[:-size], power[size:])
        size *= 2


def _ranges(values, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """sum(values[j] * BASE^(j-start)) for each [start, end); starts ascend.

    ``values(a, b)`` gives the uint64 values of positions a..b-1.
    """
    p, inv = _tables()
    out = np.empty(len(starts), np.uint64)
    if not len(starts):
        return out
    size = ends - starts
    for k in np.flatnonzero(size > _LONG):
        acc, mul = 0, 1
        for a in range(int(starts[k]), int(ends[k]), PIECE):
            b = min(a + PIECE, int(ends[k]))
            s = int(np.sum(values(a, b) * p[:b - a], dtype=np.uint64))
            acc = (acc + s * mul) % (1 << 64)
            mul = mul * pow(_BASE, b - a, 1 << 64) % (1 << 64)
        out[k] = acc
    lo = 0
    while lo < len(starts):
        a = int(starts[lo])
        hi = int(np.searchsorted(starts, a + PIECE))
        pick = np.arange(lo, hi)
        pick = pick[size[lo:hi] <= _LONG]
        if len(pick):
            b = int(ends[pick].max())
            sums = np.empty(b - a + 1, np.uint64)
            sums[0] = 0
            np.cumsum(values(a, b) * p[:b - a], out=sums[1:])
            s = starts[pick] - a
            out[pick] = (sums[ends[pick] - a] - sums[s]) * inv[s]
        lo = hi
    return out


def byte_windows(data: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints of data[s:s+size] for ascending starts."""
    eights = _eights(data)
    if size < 8:
        return mix((eights[starts] & _U((1 << 8 * size) - 1)) + _U(size))
    return mix(_ranges(lambda a, b: mix(eights[a:b] + _U(_BASE)), starts, starts + size - 7))


class Texts:
    """The texts of an Arrow column as one byte array with offsets (null: empty)."""

    def __init__(self, column):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_binary())
        a = pc.fill_null(column.cast(pa.large_binary()), b"")
        n = len(a)
        if n == 0:
            self.data, self.offsets = np.zeros(0, np.uint8), np.zeros(1, np.int64)
            return
        _, off, buf = a.buffers()
        o = np.frombuffer(off, np.int64)[a.offset:a.offset + n + 1]
        raw = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
        self.data = raw[o[0]:o[-1]]
        self.offsets = o - o[0]

    def __len__(self):
        return len(self.offsets) - 1

    def raw(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


class Words:
    """Words of a batch of texts: byte ranges, ranges per text, fingerprints."""

    def __init__(self, texts: Texts, separators=SPACES, lower: bool = False):
        data = LOWER[texts.data] if lower else texts.data
        off, n = texts.offsets, len(data)
        inside = ~separators[data]
        edge = off[(off > 0) & (off < n)]
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        before[edge] = False
        self.starts = np.flatnonzero(inside & ~before)
        before[:-1] = inside[1:]
        if n:
            before[-1] = False
        before[edge - 1] = False
        self.ends = np.flatnonzero(inside & ~before) + 1
        self.offsets = np.searchsorted(self.starts, off)
        self.data, self.texts = data, texts
        self._hash = None

    def __len__(self):
        return len(self.starts)

    @property
    def doc(self) -> np.ndarray:
        """Text number of each word."""
        return np.repeat(np.arange(len(self.texts)), np.diff(self.offsets))

    @property
    def hashes(self) -> np.ndarray:
        if self._hash is None:
            size = self.ends - self.starts
            h = mix(size.astype(np.uint64) * _U(_BASE))
            eights = _eights(self.data)
            todo = np.flatnonzero(size <= SHORT)
            at = 0
            while len(todo):
                left = size[todo] - at
                part = eights[self.starts[todo] + at]
                part &= _U(0xFFFFFFFFFFFFFFFF) >> (_U(8) * np.maximum(8 - left, 0).astype(np.uint64))
                h[todo] = _joined(h[todo], part)
                at += 8
                todo = todo[left > 8]
            for i in np.flatnonzero(size > SHORT):
                h[i] = int.from_bytes(hashlib.blake2b(self.data[self.starts[i]:self.ends[i]], digest_size=8).digest(), "little")
            self._hash = h
        return self._hash

    def window_starts(self, k: int) -> np.ndarray:
        """Word numbers at which k consecutive words of one text start."""
        last = np.repeat(self.offsets[1:], np.diff(self.offsets)) - k
        return np.flatnonzero(np.arange(len(self.starts)) <= last)

    def windows(self, starts: np.ndarray, k: int) -> np.ndarray:
        """Fingerprints of k words from each of the (ascending) word numbers."""
        h, out, lo = self.hashes, np.empty(len(starts), np.uint64), 0
        while lo < len(starts):
            a = int(starts[lo])
            hi = int(np.searchsorted(starts, a + _STEP))
            last = int(starts[hi - 1])
            out[lo:hi] = _chains(h[a:last + k], k)[starts[lo:hi] - a]
            lo = hi
        return mix(out + _U(k))


def covered(n: int, starts: np.ndarray, size) -> np.ndarray:
    """Boolean mask of the n positions covered by [s, s+size)."""
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, starts, 1)
    np.add.at(d, starts + size, -1)
    return np.cumsum(d[:-1]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal True runs."""
    m = np.concatenate([[False], mask, [False]])
    d = np.flatnonzero(m[1:] != m[:-1])
    return d[::2], d[1::2]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES):
    """Sub-batches of at most ``limit`` text bytes (one row at least)."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.concatenate([[0], np.cumsum(size.astype(np.int64))])
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + limit, side="right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi
