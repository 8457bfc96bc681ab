"""Word-window deduplication with a count-min prefilter.

1. Every block adds the fingerprints of its distinct windows (13 consecutive words) to
   a count-min sketch of ``ROWS`` rows; the cells a block touches travel as compressed
   lists and are merged per range of cells. Cells grow with the text (two cells or
   more per byte), so the sketch is nowhere held whole. A cell's count, up to two,
   comes back to the blocks as a bit: touched by more than one window, or by one.
   Estimates never fall below true counts, so a window estimated once occurs in one
   block only.
2. Windows estimated as repeated in all rows are grouped exactly, by fingerprint,
   each with the smallest document id of its block. A block learns which of its
   windows have a smaller id elsewhere.
3. Words covered by a window that a document with a smaller id has too go.

Windows that come more than once only inside one block never leave it: their order
of ids is settled there.

Defined results: null text: no words, nothing kept; fewer words than a window: all
kept; a null id is larger than any other and equal to itself, so its copies never
remove each other; rows with equal ids don't remove each other; an empty table gives
no rows; other columns are not read unless carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webmetrics.llm import blocks as B
from webmetrics.llm.words import Texts, Words, covered, mix, runs

ROWS = 2
LAST = np.iinfo(np.int64).max


def remove_repeats(docs: DataFrame, ident: str = "doc_id", text: str = "text", size: int = 13, carry=(),
                   block_bytes: int = B.BLOCK_BYTES) -> DataFrame:
    """One row per document: id, carried columns, n_words, n_removed, kept_words (kept
    words joined by a space), kept_text (the text without the removed words and the
    white space before them)."""
    if size < 1:
        raise ValueError("size must be positive")
    table = B.Blocks(docs, ident, text, carry, block_bytes=block_bytes)
    nb = table.n_buckets
    width = 1 << max(16, (2 * table.text_bytes - 1).bit_length())

    def windows(rows):
        w = Words(Texts(rows["text"]))
        starts = w.window_starts(size)
        keys, back = np.unique(w.windows(starts, size), return_inverse=True)
        return w, starts, keys, back

    def cells(keys, r):
        return mix(keys + np.uint64((r + 1) * 0x632BE59BD9B4E019 % (1 << 64))) & np.uint64(width - 1)

    def sketch(block, rows, _):
        out, keys = [], windows(rows)[2]
        for r in range(ROWS):
            c, n = np.unique(cells(keys, r), return_counts=True)
            cut = B.bucket_cuts(c, nb, width)
            out += [(r * nb + k, block, B.pack(c[a:b], n[a:b] > 1))
                    for k, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a]
        return out

    counts = table.answered(table.sent(sketch), B.repeated, 0)

    def estimated(keys, got):
        often = np.ones(len(keys), bool)
        for r in range(ROWS):
            c, back = np.unique(cells(keys, r), return_inverse=True)
            bits = {k - r * nb: x for k, x in got.get(0, {}).items() if r * nb <= k < (r + 1) * nb}
            often &= B.gathered(bits, B.bucket_cuts(c, nb, width))[back]
        return often

    def smallest(rows, w, starts, keys, back):
        ids = pc.fill_null(rows["id"].cast(pa.int64()), LAST).to_numpy()
        own = ids[w.doc[starts]]
        least = np.full(len(keys), LAST, np.int64)
        np.minimum.at(least, back, own)
        return own, least

    def exact(block, rows, got):
        w, starts, keys, back = windows(rows)
        often = estimated(keys, got)
        least = smallest(rows, w, starts, keys, back)[1][often]
        keys = keys[often]
        cut = B.bucket_cuts(keys, nb)
        return [(k, block, B.pack(keys[a:b], values=least[a:b]))
                for k, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a]

    answers = counts.unionByName(table.answered(table.sent(exact, counts), _earlier, 1))

    def finish(rows, got):
        w, starts, keys, back = windows(rows)
        own, least = smallest(rows, w, starts, keys, back)
        often = estimated(keys, got)
        outside = np.zeros(len(keys), bool)
        outside[often] = B.gathered(got.get(1, {}), B.bucket_cuts(keys[often], nb))
        gone = covered(len(w), starts[outside[back] | (own > least[back])], size)
        n, removed, words, rest = [], [], [], []
        for i in range(len(w.texts)):
            a, b = w.offsets[i], w.offsets[i + 1]
            n.append(b - a)
            removed.append(int(gone[a:b].sum()))
            words.append(_words(w, a, b, gone))
            rest.append(without(w, i, gone))
        cols = {"id": rows["id"]} | {c: rows[c] for c in rows.column_names if c[0] == "c"}
        return pa.table(cols | {"n_words": pa.array(n, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                                "kept_words": pa.array(words, pa.string()), "kept_text": pa.array(rest, pa.string())})

    kinds = [f"{c} {k.simpleString()}" for c, k in table.fields.items() if c != "text"]
    out = table.finished(finish, ", ".join(kinds) + ", n_words long, n_removed long, kept_words string, kept_text string", answers)
    return out.select(F.col("id").alias(ident), *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)],
                      "n_words", "n_removed", "kept_words", "kept_text")


def query(spark, sf_dir: str) -> DataFrame:
    """op2: windows of 13 words over ``documents``; digest of the kept words."""
    r = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return r.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_words").cast("binary"), 256).alias("kept_sha256"))


def _earlier(bodies) -> list[np.ndarray]:
    """Which keys another block has with a smaller id."""
    keys = np.concatenate([b[0] for b in bodies])
    ids = np.concatenate([b[2] for b in bodies])
    uniq, back = np.unique(keys, return_inverse=True)
    least = np.full(len(uniq), LAST, np.int64)
    np.minimum.at(least, back, ids)
    return np.split(least[back] < ids, np.cumsum([len(b[0]) for b in bodies])[:-1])


def _words(w: Words, a: int, b: int, gone: np.ndarray) -> str:
    """Kept words of one text, joined by a space."""
    if a == b:
        return ""
    lo, hi = runs(~gone[a:b])
    data, starts, ends = w.data, w.starts, w.ends
    return b" ".join(b" ".join(data[starts[a + x]:ends[a + y - 1]].tobytes().split())
                     for x, y in zip(lo, hi, strict=True)).decode(errors="replace")


def without(w: Words, i: int, gone: np.ndarray) -> str:
    """Text i without its removed words and the white space before each removed run."""
    a, b = w.offsets[i], w.offsets[i + 1]
    first, last = w.texts.offsets[i], w.texts.offsets[i + 1]
    lo, hi = runs(gone[a:b])
    if not len(lo):
        return w.texts.raw(i).decode(errors="replace")
    parts, at = [], first
    for x, y in zip(lo, hi, strict=True):
        parts.append(w.texts.data[at:w.ends[a + x - 1] if x else first].tobytes())
        at = w.ends[a + y - 1]
    parts.append(w.texts.data[at:last].tobytes())
    out = b"".join(parts).decode(errors="replace")
    return out if len(lo) != 1 or lo[0] or hi[0] < b - a else ""
