"""Near duplicates against exact all-pairs components; sketch properties."""

import numpy as np

from webmetrics.llm import minhash
from webmetrics.llm.words import Texts
from tests.llm.fixtures import SEP, frame, texts

UPPER = {c: c + 32 for c in range(65, 91)}


def shingle_set(t, k=5):
    w = SEP.findall((t or "").translate(UPPER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def brute(rows, percent=75):
    sets = {i: shingle_set(t) for i, t in rows}
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by = {}
    for i in ids:
        for s in sets[i]:
            by.setdefault(s, []).append(i)
    seen = set()
    for group in by.values():
        for a in group:
            for b in group:
                if a < b and (a, b) not in seen:
                    seen.add((a, b))
                    n = len(sets[a] & sets[b])
                    if 100 * n >= percent * len(sets[a] | sets[b]):
                        x, y = sorted((root(a), root(b)))
                        parent[y] = x
    return sorted((i, len(sets[i]), root(i), root(i) == i) for i in ids)


def chain(seed=5):
    """Copies edited step by step: ends of a chain are not linked, neighbours are."""
    import random
    r = random.Random(seed)
    words = [f"W{r.randrange(900)}" for _ in range(120)]
    rows = []
    for i in range(40):
        words = list(words)
        words[r.randrange(120)] = f"new{i}"
        words[r.randrange(120)] = f"also{i}"
        rows.append((1000 - 7 * i, " ".join(words)))
    return rows


def test_components_match_brute_force(spark):
    rows = [(i, t) for i, t in {i: t for i, t in texts(3, 80) if i is not None}.items()] + chain()
    got = sorted(tuple(r) for r in minhash.near_duplicates(frame(spark, rows)).collect())
    assert got == brute(rows)


def test_whole_table(spark):
    from tests.conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in minhash.query(spark, SF_SMALL).collect()) == brute(rows)


def test_every_coordinate_fills_and_estimates(spark):
    a, b = list(range(1, 401)), list(range(101, 501))
    h = np.array(a + b + [7], np.uint64)
    s = minhash.sketches(h, np.array([0, 400, 800, 801]), 192)
    assert (s != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    assert abs((s[0] == s[1]).mean() - 300 / 500) < 0.15


def test_short_and_empty_sets():
    import pyarrow as pa
    h, off = minhash.shingles(Texts(pa.array(["a b", "A  b", None, " ", "a b c d e f", "a a a a a a a"])), 5)
    assert np.diff(off).tolist() == [1, 1, 0, 0, 2, 1]
    assert h[0] == h[1]


def test_null_and_repeated_ids_and_empty_table(spark):
    t = "one two three four five six seven eight"
    got = minhash.near_duplicates(frame(spark, [(None, t), (4, t), (4, t), (5, None), (6, "")])).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted(
        [(None, 4, None, True), (4, 4, None, False), (4, 4, None, False), (5, 0, 5, True), (6, 0, 6, True)], key=repr)
    assert minhash.near_duplicates(frame(spark, []).limit(0)).count() == 0


def test_large_group_of_unlinked_and_linked_copies(spark):
    """Copies edited on their own, many not linked to the original or each other."""
    import random
    r = random.Random(8)
    words = [f"w{r.randrange(500)}" for _ in range(140)]
    rows = [(900, " ".join(words))]
    for i in range(220):
        w = list(words)
        for _ in range(r.choice((2, 4, 6, 7))):
            w[r.randrange(140)] = r.choice(("is", "it", "of", f"u{i}"))
        rows.append((i, " ".join(w)))
    got = sorted(tuple(x) for x in minhash.near_duplicates(frame(spark, rows)).collect())
    assert got == brute(rows) and len({x[2] for x in got}) > 5


def test_each_row_is_a_document(spark):
    """Null and repeated ids with different texts, some of them copies of others."""
    import random

    import corpus_pipeline
    r = random.Random(2)
    t = [" ".join(r.choice("abcdefgh") + str(r.randrange(500)) for _ in range(40)) for _ in range(40)]
    rows = [(None, t[k]) for k in range(12)] + [(5, t[12]), (5, t[13]), (5, t[14]), (6, t[13]), (8, t[3]), (9, t[20]), (9, t[20]), (3, t[14] + " end")]
    rows += [(20 + k, t[21 + k]) for k in range(10)]
    got = minhash.near_duplicates(frame(spark, rows)).collect()
    assert len(got) == len(rows) and sum(x["kept"] for x in got) == 26
    comp = {k: sorted((x["component_id"], x["kept"]) for x in got if x["doc_id"] == k) for k in (3, 5, 6, 8, 9)}
    assert comp == {3: [(3, True)], 5: [(3, False), (5, True), (5, True)], 6: [(5, False)], 8: [(None, False)], 9: [(9, False), (9, True)]}
    assert all(x["kept"] and x["component_id"] is None for x in got if x["doc_id"] is None)
    left = corpus_pipeline.near_duplicates(spark, frame(spark, rows), "")
    assert left.columns == frame(spark, rows).columns
    want = [(None, t[k]) for k in range(12)] + [(5, t[12]), (5, t[13]), (9, t[20]), (3, t[14] + " end")] + [(20 + k, t[21 + k]) for k in range(10)]
    assert sorted(((x["doc_id"], x["text"]) for x in left.collect()), key=repr) == sorted(want, key=repr)
