"""Quality rules: counts per document and divergence from language references.

First pass: every document with a language adds its characters (by class) and words
(by 2^14 ranges of the word's fingerprint) to its language's histograms; tasks add up
before anything is shuffled. A language's common words are its ``COMMON`` fullest
ranges; a frequent word makes its range stand out, rare ones even out. Each language
with ``REFERENCE_WORDS`` words in ``REFERENCE_DOCS`` documents has a reference, whatever its
share of the corpus.

Second pass: for each document the Jensen-Shannon distances (base 2) of its character
classes and of its common words (and the rest as one class) to every reference, without a
shuffle; references are collected in groups of ``GROUP``, one pass a group. A document passes
if, for some language, both distances are within their limits. The limit on common words is
a share of the distance that a text without any common word has, which follows from the
reference: ``max_common`` of it, and more for short texts (``SHORT / n_words``), whose
histograms are noise. Documents under ``min_words`` are not judged by distance at all.

Defined results: a null or wordless text has zero counts and fails the base rules; no
references: distances null, the base rules decide, as they do for documents tagged with a
language that has no reference; an empty table gives no rows; repeated rows are judged each
by itself; other columns are not read unless carried. A tag is used for nothing else, so
a document is judged alike with and without the tag of a language that has a reference.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webmetrics.llm.blocks import written
from webmetrics.llm.frames import mapped, narrowed, ship
from webmetrics.llm.words import Texts, Words, covered, mix, slices

COMMON = 64
RANGES = 1 << 14
#: A language with fewer words is not known well enough to reject a document by.
REFERENCE_WORDS, REFERENCE_DOCS = 1000, 5
GROUP = 4096        # references (about a kilobyte each) in a task at once
SHORT = 5.0
_HELD = 64          # languages whose histograms a task holds before it sends them
_SHIFT = np.uint64(64 - 14)
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

#: Character classes by first byte: space, digit, lower, upper, symbol, sentence mark,
#: other ASCII, and letters beyond ASCII by size of their code points.
CLASSES = 10
_CLASS = np.full(256, 6, np.int64)
_CLASS[0x30:0x3A], _CLASS[0x61:0x7B], _CLASS[0x41:0x5B] = 1, 2, 3
_CLASS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
_CLASS[SYMBOLS] = 4
_CLASS[list(b".,;:!?'\"()-")] = 5
_CLASS[0x80:0xE0], _CLASS[0xE0:0xF0], _CLASS[0xF0:] = 7, 8, 9


def _classes(t: Texts) -> np.ndarray:
    """Characters by class of each text."""
    first = (t.data & 0xC0) != 0x80
    doc = np.repeat(np.arange(len(t)), np.diff(t.offsets))
    return np.bincount(doc[first] * CLASSES + _CLASS[t.data[first]], minlength=len(t) * CLASSES).reshape(-1, CLASSES)


def references(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, ref): each language and, if enough is known of it, the packed reference."""
    def sent(held):
        for name, n in held.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(at)), "cell": pa.array(at, pa.int64()),
                                              "n": pa.array(n[at], pa.int64())})

    def count(batches):
        held: dict[str, np.ndarray] = {}        # characters by class, words by range, documents
        for batch in batches:
            for piece in slices(batch, "text"):
                langs = np.array(piece.column("lang").to_pylist(), object)
                t = Texts(piece.column("text"))
                c, w = _classes(t), Words(t)
                r, doc = (w.hashes >> _SHIFT).astype(np.int64), w.doc
                for name in set(langs):
                    rows = langs == name
                    n = np.concatenate([c[rows].sum(axis=0), np.bincount(r[rows[doc]], minlength=RANGES), [rows.sum()]])
                    held[name] = held.get(name, 0) + n
                    if len(held) > _HELD:
                        yield from sent(held)
                        held = {}
        yield from sent(held)

    ship(docs.sparkSession)
    flat = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).where("lang is not null")
    cells = flat.mapInArrow(count, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    packed = cells.groupBy("lang").agg(F.collect_list(F.struct("cell", "n")).alias("cells"))

    def pack(batches):
        for batch in batches:
            refs = []
            for cells in batch.column("cells"):
                n = np.zeros(CLASSES + RANGES + 1)
                n[cells.values.field("cell").to_numpy()] = cells.values.field("n").to_numpy()
                chars, each = n[:CLASSES], n[CLASSES:-1]
                top = np.sort(np.argsort(-each, kind="stable")[:COMMON])
                common = np.append(each[top], each.sum() - each[top].sum())
                enough = each.sum() >= REFERENCE_WORDS and n[-1] >= REFERENCE_DOCS
                refs.append(np.concatenate([chars / chars.sum(), top, common / common.sum()]).tobytes() if enough else None)
            yield pa.RecordBatch.from_pydict({"lang": batch.column("lang"), "ref": pa.array(refs, pa.binary())})

    return written(packed.mapInArrow(pack, "lang string, ref binary"), "references")


def unpacked(ref: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class distribution, common ranges, their distribution and the rest's."""
    chars, top, common = np.split(np.frombuffer(ref), [CLASSES, CLASSES + COMMON])
    return chars, top.astype(np.int64), common


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2) of each row of p to q."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=1)
        b = np.where(q > 0, q * np.log2(q / m), 0).sum(axis=1)
    return np.sqrt(np.clip((a + b) / 2, 0, 1))


def without_common(common: np.ndarray) -> float:
    """Distance of a text without any common word to a reference's common words."""
    none = np.zeros((1, len(common)))
    none[0, -1] = 1
    return float(distance(none, common)[0])


def counts(t: Texts, w: Words, window: int = 8) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    d, n = t.data, len(t)
    inside = np.zeros(len(d) + 1, np.int8)
    inside[w.starts] += 1
    inside[w.ends] -= 1
    inside = np.cumsum(inside[:-1], dtype=np.int8) > 0

    def per_text(mask, offsets=t.offsets):
        c = np.concatenate([[0], np.cumsum(mask)])
        return c[offsets[1:]] - c[offsets[:-1]]

    out = {"n_words": np.diff(w.offsets), "word_chars": per_text(inside & ((d & 0xC0) != 0x80)),
           "n_symbols": per_text(SYMBOLS[d])}
    cut = np.flatnonzero(d == 10)
    starts = np.unique(np.concatenate([t.offsets[:-1], cut + 1]))
    starts = starts[starts < len(d)]
    ends = np.minimum(np.append(starts[1:], len(d)), np.append(cut, len(d))[np.searchsorted(cut, starts)])
    has = np.concatenate([[0], np.cumsum(inside)])
    full = has[ends] > has[starts]
    starts, ends = starts[full], ends[full]
    doc = np.searchsorted(t.offsets, starts, side="right") - 1
    out["n_dup_lines"] = np.zeros(n, np.int64)
    raw, seen, now = d.tobytes(), set(), -1
    for a, b, i in zip(starts.tolist(), ends.tolist(), doc.tolist(), strict=True):
        if i != now:
            seen, now = set(), i
        line = raw[a:b]
        if line in seen:
            out["n_dup_lines"][i] += 1
        seen.add(line)
    s = w.window_starts(window)
    h = mix(w.windows(s, window) + w.doc[s].astype(np.uint64))
    _, back, times = np.unique(h, return_inverse=True, return_counts=True)
    out["n_repeat_words"] = per_text(covered(len(w), s[times[back] > 1], window), w.offsets)
    return out


def _groups(known: DataFrame) -> list[list]:
    """The references, as lists that a task can hold."""
    refs = known.where(F.col("ref").isNotNull())
    n = max(1, -(-refs.count() // GROUP))
    rows = lambda g: refs.where(F.pmod(F.xxhash64("lang"), F.lit(n)) == g).orderBy("lang").collect()
    return [[unpacked(r["ref"]) for r in rows(g)] for g in range(n)]


def judged(docs: DataFrame, ident: str = "doc_id", text: str = "text", lang: str = "lang", carry=(),
           min_words: int = 50, max_class: float = 0.3, max_common: float = 0.9, refs: list | None = None) -> DataFrame:
    """One row per document: id, carried columns, the counts, base_failed, class_distance,
    common_distance (to the nearest language, by the larger share of its limit), kept.
    ``refs``: unpacked references; None: those of the documents themselves."""
    free = F.lit(False)
    groups = [refs] if refs is not None else None
    if groups is None:
        known = references(docs, text, lang)
        groups = _groups(known)
        unknown = known.where("ref is null").select(F.col("lang").alias("~lang"))
        if not unknown.isEmpty():
            docs = docs.join(unknown, F.col(f"`{lang}`") == F.col("~lang"), "left")
            free = F.col("~lang").isNotNull()
    flat = narrowed(docs, ident, text, carry, free=free, best=F.lit(float("inf")), a=F.lit(float("nan")), b=F.lit(float("nan")))
    for group in groups[:-1]:
        def run(batches, group=group):
            for batch in batches:
                for piece in slices(batch, "text"):
                    t = Texts(piece.column("text"))
                    new = _nearest(piece, t, Words(t), group, max_class, max_common)
                    yield pa.RecordBatch.from_pydict({n: piece.column(n) for n in piece.schema.names} | dict(zip(("best", "a", "b"), map(pa.array, new), strict=True)))
        flat = written(flat.mapInArrow(run, flat.schema), "judged")
    last, judging = groups[-1], any(groups)

    def judge(batch):
        t = Texts(batch.column("text"))
        w = Words(t)
        c = counts(t, w)
        bad = (c["n_words"] < 20) | (100 * c["n_repeat_words"] > 30 * c["n_words"])
        best, a, b = _nearest(batch, t, w, last, max_class, max_common)
        passed = (c["n_words"] < min_words) | (best <= 1) | batch.column("free").to_numpy(zero_copy_only=False) | (not judging)
        out = {k: pa.array(x, pa.int64()) for k, x in c.items()}
        return out | {"base_failed": pa.array(bad), "class_distance": pa.array(a, pa.float64(), from_pandas=True),
                      "common_distance": pa.array(b, pa.float64(), from_pandas=True), "kept": pa.array(~bad & passed)}

    kind = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "base_failed boolean, class_distance double, common_distance double, kept boolean")
    return mapped(flat, judge, kind, ident, carry, text)


def _nearest(batch, t: Texts, w: Words, refs: list, max_class: float, max_common: float):
    """Share of the limits and distances to the nearest reference, of these or earlier ones."""
    chars = _classes(t).astype(float)
    chars /= np.maximum(chars.sum(axis=1, keepdims=True), 1)
    ranges, doc, n = (w.hashes >> _SHIFT).astype(np.int64), w.doc, np.diff(w.offsets)
    best, near_a, near_b = [np.array(batch.column(x).to_numpy(zero_copy_only=False), float) for x in ("best", "a", "b")]
    more = max_common + SHORT / np.maximum(n, 1)
    for ref, top, common in refs:
        at = np.full(RANGES, len(top))
        at[top] = np.arange(len(top))
        h = np.bincount(doc * (len(top) + 1) + at[ranges], minlength=len(t) * (len(top) + 1)).reshape(len(t), -1)
        a = distance(chars, ref)
        b = distance(h / np.maximum(h.sum(axis=1, keepdims=True), 1), common)
        share = np.maximum(a / max_class, b / (without_common(common) * more))
        closer = share < best
        best, near_a, near_b = [np.where(closer, x, y) for x, y in ((share, best), (a, near_a), (b, near_b))]
    return best, near_a, near_b


def query(spark, sf_dir: str) -> DataFrame:
    """op8: quality rules over ``documents``."""
    return judged(spark.read.parquet(f"{sf_dir}/documents.parquet"))
