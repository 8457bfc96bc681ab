"""Byte and word-window deduplication against brute force."""

import hashlib
from collections import defaultdict

import pytest

from webmetrics.llm import suffix_dedup, window_dedup
from tests.llm.fixtures import SEP, frame, texts


def brute_bytes(rows, length):
    at = defaultdict(int)
    data = [(i, (t or "").encode()) for i, t in rows]
    for _, b in data:
        for k in range(len(b) - length + 1):
            at[b[k:k + length]] += 1
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if at[b[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def brute_windows(rows, size):
    least, docs = {}, [(i, SEP.findall(t or "")) for i, t in rows]
    for i, w in docs:
        for k in range(len(w) - size + 1):
            key = tuple(w[k:k + size])
            if i is not None:
                least[key] = min(least.get(key, i), i)
            else:
                least.setdefault(key, None)
    out = []
    for i, w in docs:
        gone = set()
        for k in range(len(w) - size + 1):
            m = least[tuple(w[k:k + size])]
            if m is not None and (i is None or m < i):
                gone.update(range(k, k + size))
        kept = " ".join(x for n, x in enumerate(w) if n not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def digest1(df):
    out = []
    for r in df.collect():
        s = r["spans"]
        out.append((r["doc_id"], r["n_bytes"], sum(x["end"] - x["start"] for x in s), len(s), hashlib.sha256(r["kept"]).hexdigest()))
    return sorted(out, key=repr)


def digest2(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept_words"].encode()).hexdigest())
                   for r in df.collect()), key=repr)


@pytest.mark.parametrize("length,block", [(200, 6 << 20), (200, 4000), (40, 3000), (5, 4000)])
def test_bytes_match_brute_force(spark, length, block):
    rows = texts()
    df = suffix_dedup.remove_repeats(frame(spark, rows), length=length, block_bytes=block)
    assert df.columns == ["doc_id", "n_bytes", "spans", "kept"]
    assert digest1(df) == brute_bytes(rows, length)


def test_bytes_whole_table(spark):
    from tests.conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in suffix_dedup.query(spark, SF_SMALL).collect()), key=repr)
    assert got == brute_bytes(rows, 200)


@pytest.mark.parametrize("size,block", [(13, 6 << 20), (13, 3000), (2, 3000), (1, 6 << 20)])
def test_windows_match_brute_force(spark, size, block):
    rows = texts(2)
    df = window_dedup.remove_repeats(frame(spark, rows), size=size, block_bytes=block, carry=("lang", "kept"))
    assert digest2(df) == brute_windows(rows, size)
    assert {r["kept"] for r in df.collect()} == {"y"}


def test_windows_whole_table(spark):
    from tests.conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in window_dedup.query(spark, SF_SMALL).collect()), key=repr)
    assert got == brute_windows(rows, 13)


def test_kept_text_leaves_the_rest_untouched(spark):
    a = "one two three four five six seven eight nine ten eleven twelve thirteen"
    rows = [(1, a), (2, f"Start \n here:  {a}\nand  then\tgo on"), (3, a), (4, f"{a} tail"), (5, None)]
    got = {r["doc_id"]: r["kept_text"] for r in window_dedup.remove_repeats(frame(spark, rows)).collect()}
    assert got == {1: a, 2: "Start \n here:\nand  then\tgo on", 3: "", 4: " tail", 5: ""}


def test_empty_tables(spark):
    none = frame(spark, []).limit(0)
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert window_dedup.remove_repeats(none).count() == 0
