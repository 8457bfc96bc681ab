"""Two-pass external shuffle: whole rows, even shards, draws that any order of rows repeats."""

import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from webmetrics.llm import sharding
from tests.conftest import SF_SMALL
from tests.llm.fixtures import frame, texts


def check_law(rows, shards):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in by.values())
    n = [len(by.get(s, ())) for s in range(shards)]
    assert max(n) - min(n) <= 1 and set(by) <= set(range(shards))


def test_fisher_yates_is_a_permutation_and_uniform():
    for n in (0, 1, 2, 100):
        assert sorted(sharding.fisher_yates(n, 1, 2).tolist()) == list(range(n))
    seen = Counter(tuple(sharding.fisher_yates(3, 5, b).tolist()) for b in range(6000))
    assert len(seen) == 6 and min(seen.values()) > 850


def test_start_of_buckets_in_two_levels(spark):
    n = {b: b % 7 for b in range(0, 3 * sharding._GROUP, 5)}
    got = {r["bucket"]: r["first"] for r in sharding.starts(spark.createDataFrame(list(n.items()), "bucket long, n long")).collect()}
    total, want = 0, {}
    for b in sorted(n):
        want[b], total = total, total + n[b]
    assert got == want


def test_edge_cases_keep_every_row(spark):
    rows = texts() + [(None, "same")] * 40 + [(7, "same")] * 40
    docs = frame(spark, rows).withColumn("shard", F.lit("x")).withColumn("draw", F.lit(1)).withColumn("c0", F.lit(2))
    out = sharding.sharded(docs, bucket_bytes=2000, shards=5)
    got = out.collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(rows)
    assert set(docs.columns) | {"slot"} == set(out.columns) and all(r["c0"] == 2 and r["kept"] == "y" for r in got)
    check_law(got, 5)
    assert sharding.sharded(frame(spark, []).limit(0)).count() == 0


def test_same_shards_whatever_the_order_of_rows(spark):
    rows = [(i, f"text {i}" * (i % 9)) for i in range(500)]
    a = sharding.sharded(frame(spark, rows).repartition(7), bucket_bytes=1000).collect()
    b = sharding.sharded(frame(spark, rows[::-1]).coalesce(1), bucket_bytes=1000).collect()
    c = sharding.sharded(frame(spark, rows), bucket_bytes=1000, seed=12).collect()
    place = lambda t: {r["doc_id"]: (r["shard"], r["slot"]) for r in t}
    assert place(a) == place(b) != place(c)
    ids = [r["doc_id"] for r in sorted(a, key=lambda r: (r["shard"], r["slot"]))]
    assert abs(np.corrcoef(ids, range(len(ids)))[0, 1]) < 0.2


def test_rows_of_a_file_are_in_order_of_slot(spark):
    t = sharding.sharded(frame(spark, [(i, "x" * 50) for i in range(300)]), bucket_bytes=4000)
    for r in t.groupBy(F.input_file_name().alias("f")).agg(F.collect_list("slot").alias("s")).collect():
        assert r["s"] == sorted(r["s"])


def test_query(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = sharding.query(spark, SF_SMALL).collect()
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in got} == {i: (len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in docs.items()}
    assert len(got) == len(docs) and {(r["law"], r["grown_shard"]) for r in got} == {("rows", None)}
    check_law(got, 24)
