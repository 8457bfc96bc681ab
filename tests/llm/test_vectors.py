"""Vector codes and centroid clusters against plain Python integers."""

import hashlib
import math

import numpy as np
import pytest

from webmetrics.llm import centroids, vector_codes, vectors
from tests.conftest import SF_SMALL


def table(seed, n, dims, spread=0.2):
    """(vec_id, embedding, label): ties, copies, nulls, non-finite and large components."""
    r = np.random.default_rng(seed)
    rows = [(int(i), [float(np.float32(x)) for x in r.normal(0, spread, dims)], int(i) % 3 or None) for i in range(n)]
    rows += [(n + i, rows[i % 5][1], None) for i in range(40)]
    rows += [(n + 100, None, 1), (n + 101, [None] * dims, 1), (n + 102, [math.nan] * dims, 1), (n + 103, [math.inf] + [0.0] * (dims - 1), 1),
             (n + 104, [-math.inf] * dims, 1), (n + 105, [1.0] * (dims + 4), 2), (None, [0.5] * dims, 9), (3, [0.25] * dims, None),
             (3, [0.25] * dims, None), (n + 106, [], 5)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*x, "v", 4) for x in rows], "vec_id long, embedding array<double>, label long, v string, code int")


def whole(x, scale):
    return [int(math.floor(scale * v)) if abs(v) < 1e15 else int(v) * scale for v in x]


def ok(v, dims):
    return v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)


def sq(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def lloyd(x, start, rounds):
    """Assignments, distances and the entries, in plain integers."""
    c = [list(e) for e in start]
    def at():
        out = []
        for v in x:
            d = [sq(v, e) for e in c]
            out.append((d.index(min(d)), min(d)))
        return out
    for _ in range(rounds):
        got = at()
        for k in range(len(c)):
            mine = [v for v, (a, _) in zip(x, got, strict=True) if a == k]
            if mine:
                c[k] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    return at(), c


@pytest.mark.parametrize("bits,dims", [(3, 16), (20, 16), (27, 16), (26, 64), (27, 3)])
def test_limb_products_are_exact(bits, dims):
    r = np.random.default_rng(bits)
    x = r.integers(-(1 << bits), (1 << bits) + 1, (50, dims))
    c = r.integers(-(1 << bits), (1 << bits) + 1, (20, dims))
    want = x.astype(object) @ c.astype(object).T
    assert (vector_codes.products(x, c).astype(object) == want).all()
    width = (53 - dims.bit_length()) // 2
    assert dims * (1 << 2 * width) < 1 << 53
    assert all(np.abs(a).max() <= 1 << width for a in vector_codes._split(x, width))


def test_first_of_equal_entries_and_large_components():
    x = np.array([[0, 0], [4, 0], [2, 0]])
    c = np.array([[0, 0], [4, 0], [0, 0], [4, 0]])
    assert vector_codes.nearest(x, c)[0].tolist() == [0, 1, 0]
    big = np.array([[10 ** 30, 0], [10 ** 30 - 7, 1]], object)
    k, d = vector_codes.nearest(big, np.array([[10 ** 30 - 5, 0], [10 ** 30, 0]], object))
    assert k.tolist() == [1, 0] and d.tolist() == [0, 5]


@pytest.mark.parametrize("dims,spread", [(8, 0.2), (64, 0.2), (8, 1e4), (8, 1e12), (8, 1e30), (6, 1.0), (2, 1.0)])
def test_codes_match_plain_integers(spark, dims, spread):
    rows = table(dims, 60, dims, spread)
    docs = frame(spark, rows).repartition(5)
    books = vector_codes.train(docs, entries=20)
    got = vector_codes.encode(docs, books, carry=["label", "v"])
    kept = sorted([(i is None, i or 0, v, lab) for i, v, lab in rows if ok(v, dims)], key=lambda r: r[:3])
    x = [whole(v, 1024) for _, _, v, _ in kept]
    code, error = [""] * len(x), [0] * len(x)
    for p in range(4):
        a, b = dims * p // 4, dims * (p + 1) // 4
        part = [v[a:b] for v in x]
        at, book = lloyd(part, part[:20], 4)
        assert books.books[p] == book
        for i, (k, d) in enumerate(at):
            code[i] += f"{k:02x}"
            error[i] += d
    want = sorted([(repr(None if n else i), c, min(e, vectors.MAX_LONG), repr(lab)) for (n, i, _, lab), c, e in zip(kept, code, error, strict=True)])
    assert sorted((repr(r["vec_id"]), r["code"], r["error"], repr(r["label"])) for r in got.collect()) == want
    by = {}
    for _, _, e, lab in want:
        by[lab] = by.get(lab, 0) + e
    assert {(repr(r["label"]), r["label_error"]) for r in vector_codes.with_error_by(got, "label").collect()} == {(k, min(v, vectors.MAX_LONG)) for k, v in by.items()}
    assert all(len(vector_codes.decoded(r["code"], books)) == dims for r in got.collect())


def test_codes_of_nothing(spark):
    for rows in ([], [(1, None, 1)], [(1, [], 1), (2, [], None)]):
        t = frame(spark, rows)
        books = vector_codes.train(t)
        out = vector_codes.with_error_by(vector_codes.encode(t, books, carry=["label"]), "label").collect()
        assert len(out) == sum(1 for r in rows if r[1] is not None) and all(r["error"] == 0 and r["label_error"] == 0 for r in out)


@pytest.mark.parametrize("block", [1, 3, 8])
def test_dictionaries_lose_nothing(block):
    r = np.random.default_rng(1)
    for x in (r.integers(-3, 3, (500, 8)), r.integers(-10 ** 6, 10 ** 6, (300, 8)), r.integers(-9, 9, (50, 8)).astype(object) * 10 ** 25):
        books, codes = centroids.encode_chunk(x, block)
        back = np.concatenate([b[c] for b, c in zip(books, codes, strict=True)], axis=1)
        assert (back == x).all() and all(len(set(map(tuple, b.tolist()))) == len(b) for b in books)
        c = x[[3, 7, 3]]
        at, far = centroids.assigned(books, codes, c, block)
        for v, k, d in zip(x.tolist(), at, far, strict=True):
            each = [sq(v, e) for e in c.tolist()]
            assert (k, d) == (each.index(min(each)), min(each))


@pytest.mark.parametrize("dims,spread,chunk_rows", [(64, 0.2, 1 << 16), (64, 0.02, 7), (6, 1e13, 30), (6, 1e30, 11)])
def test_clusters_match_plain_integers(spark, dims, spread, chunk_rows):
    rows = table(dims, 70, dims, spread)
    chunks = centroids.Chunks(frame(spark, rows).repartition(3), carry=["v"], dims=dims, chunk_rows=chunk_rows)
    c = centroids.train(chunks)
    draw = lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest()
    kept = sorted([(i is None, "" if i is None else draw(i), v, i) for i, v, _ in rows if ok(v, dims)], key=lambda r: r[:3])
    x = [whole(v, 64) for _, _, v, _ in kept]
    at, book = lloyd(x, x[:16], 3)
    assert c == book
    got = centroids.with_inertia(centroids.clustered(chunks, c), c).collect()
    assert sorted((repr(r["vec_id"]), r["cluster"], r["distance"]) for r in got) == sorted(
        (repr(i), k, min(d, vectors.MAX_LONG)) for (_, _, _, i), (k, d) in zip(kept, at, strict=True))
    assert all(r["v"] == "v" and r["centroid_sha256"] == hashlib.sha256(",".join(map(str, book[r["cluster"]])).encode()).hexdigest() for r in got)
    total = {}
    for k, d in at:
        total[k] = total.get(k, 0) + min(d, vectors.MAX_LONG)
    assert {(r["cluster"], r["cluster_inertia"], r["inertia"]) for r in got} == {
        (k, min(v, vectors.MAX_LONG), min(sum(total.values()), vectors.MAX_LONG)) for k, v in total.items()}


def test_clusters_of_nothing_and_few(spark):
    for rows in ([], [(1, None, 1)], [(1, [0.0] * 64, 1), (1, [0.0] * 64, 1), (2, [1.0] * 64, 1)]):
        chunks = centroids.Chunks(frame(spark, rows))
        c = centroids.train(chunks)
        got = centroids.with_inertia(centroids.clustered(chunks, c), c).collect()
        assert len(got) == len(c) == sum(1 for r in rows if r[1] is not None) and all(r["inertia"] == 0 for r in got)


def test_queries(spark):
    n = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").count()
    assert vector_codes.query(spark, SF_SMALL).count() == n == centroids.query(spark, SF_SMALL).count()
