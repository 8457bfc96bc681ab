"""Fingerprints: no collisions by construction, against plain words and windows."""

import random

import numpy as np
import pyarrow as pa

from tests.llm.fixtures import frame
from tests.llm.test_maps import brute_counts, brute_leaks
from tests.llm.test_minhash import brute
from tests.llm.test_substrings import brute_windows
from webmetrics.llm import decontaminate, minhash, quality, window_dedup
from webmetrics.llm.words import Texts, Words, byte_windows


def thue_morse(n):
    """A word and its complement; sums of powers modulo 2^64 are equal from 1,024 letters on."""
    s = "a"
    while len(s) < n:
        s += s.translate(str.maketrans("ab", "ba"))
    return s, s.translate(str.maketrans("ab", "ba"))


def test_same_text_same_fingerprint_and_no_other():
    r = random.Random(1)
    words = ["".join(r.choice("abcd\u00e9") for _ in range(r.choice([1, 2, 7, 8, 9, 15, 16, 17, 63, 64, 65, 200]))) for _ in range(300)]
    w = Words(Texts(pa.array([" ".join(r.choice(words) for _ in range(400)) for _ in range(5)])))
    raw = [w.data[a:b].tobytes() for a, b in zip(w.starts, w.ends, strict=True)]

    def same(keys, h):
        assert len(set(zip(keys, h.tolist(), strict=True))) == len(set(keys)) == len(set(h.tolist()))

    same(raw, w.hashes)
    for k in (1, 2, 3, 5, 8, 10, 13):
        s = w.window_starts(k)
        h = w.windows(s, k)
        same([tuple(raw[i:i + k]) for i in s], h)
        assert (w.windows(s[::7], k) == h[::7]).all()
    for size in (1, 3, 7, 8, 9, 20, 200):
        s = np.arange(len(w.data) - size + 1)
        same([w.data[i:i + size].tobytes() for i in s], byte_windows(w.data, s, size))


def test_thue_morse_words_windows_and_bytes():
    for n in (64, 128, 1024, 2048, 1 << 16):
        a, b = thue_morse(n)
        assert len(set(Words(Texts(pa.array([f"{a} {b}"]))).hashes.tolist())) == 2
        w = Words(Texts(pa.array([" ".join(a[:2048]), " ".join(b[:2048])])))
        assert len(set(w.windows(np.array([0, w.offsets[1]]), min(n, 2048)).tolist())) == 2
        assert len(set(byte_windows(np.frombuffer((a + b).encode(), np.uint8), np.array([0, n]), n).tolist())) == 2


def test_operators_tell_thue_morse_words_apart(spark):
    rows, item = [], []
    for k, n in enumerate((1024, 2048)):
        a, b = thue_morse(n)
        rest = [f"w{k}x{i}" for i in range(12)]
        rows += [(10 * k, " ".join([a, *rest])), (10 * k + 1, " ".join([b, *rest])), (10 * k + 2, f"{a}\n{b}\n{a}")]
        item.append((f"i{k}", " ".join([a, *rest[:9]])))
    docs = frame(spark, rows)
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"]) for r in window_dedup.remove_repeats(docs).collect())
    assert got == sorted(x[:3] for x in brute_windows(rows, 13)) and not any(x[2] for x in got)
    near = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs).collect())
    assert near == sorted(tuple(x) for x in brute(rows))
    hits = {r["doc_id"]: (r["n_words"], r["n_hit"]) for r in decontaminate.decontaminate(docs, spark.createDataFrame(item, "item_id string, text string")).collect()}
    assert hits == {x[0]: (x[1], x[2]) for x in brute_leaks(rows, item)} and hits[1][1] == 0 < hits[0][1]
    lines = {r["doc_id"]: r["n_dup_lines"] for r in quality.judged(docs, refs=[]).collect()}
    assert lines == {i: brute_counts(t)[3] for i, t in rows} and lines[2] == 1
