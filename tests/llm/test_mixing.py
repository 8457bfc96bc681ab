"""Pfair mixing: deviation under one block, against a plain simulation, edge cases."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from webmetrics.llm import mixing
from tests.llm.fixtures import frame


def simulate(shares, period):
    """Slot by slot: released block with the earliest deadline."""
    k, out = {n: 0 for n in shares}, []
    for t in range(period):
        ready = [(-(-(k[n] + 1) * period // s), n) for n, s in shares.items() if k[n] < s and k[n] * period // s <= t]
        n = min(ready)[1]
        out.append((n, k[n], t))
        k[n] += 1
    return sorted(out)


def sources(spark, weights):
    return spark.createDataFrame([(f"s{i}", 10, float(w)) for i, w in enumerate(weights)], "key string, blocks long, weight double")


@pytest.mark.parametrize("weights,period", [([5, 3, 2], 10), ([0.494] + [0.0926] * 19, 200), ([1, 1000], 50), ([7], 5), ([1] * 30 + [5000], 40)])
def test_pattern(spark, weights, period):
    src = mixing.shares(sources(spark, weights), period).cache()
    shares = {r["number"]: r["share"] for r in src.collect()}
    assert sum(shares.values()) == period and min(shares.values()) >= 1
    got = sorted(tuple(r) for r in mixing.pattern(src, period).collect())
    assert got == simulate(shares, period)
    done = Counter()
    for n, _, t in sorted(got, key=lambda x: x[2]):
        done[n] += 1
        for m, s in shares.items():
            assert abs(done[m] - s * (t + 1) / period) < 1


def test_mix_holds_weights_and_is_whole(spark):
    rows = [(i, f"s{0 if i % 3 else i % 7}") for i in range(3000)] + [(5000 + i, None) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    m = mixing.mixed(docs, {"s0": 4, "s3": 2, "s6": 1, None: 1, "absent": 9}, block_docs=8, period=40).collect()
    slots = defaultdict(set)
    for r in m:
        slots[r["_slot"]].add(r["source"])
    assert sorted(slots) == list(range(len(slots))) and all(len(x) == 1 for x in slots.values())
    done = Counter()
    w = {"s0": 0.5, "s3": 0.25, "s6": 0.125, None: 0.125}
    for t in range(len(slots)):
        done[next(iter(slots[t]))] += 1
        for s, x in w.items():
            assert abs(done[s] - x * (t + 1)) < 1
    times = Counter((r["source"], r["doc_id"], r["_epoch"]) for r in m)
    assert max(times.values()) == 1 and max(r["_epoch"] for r in m) <= 3
    per = defaultdict(Counter)
    for r in m:
        per[r["source"]][r["_slot"]] += 1
    assert all(n <= 8 for c in per.values() for n in c.values())
    assert sum(1 for r in m if r["source"] is None and r["_epoch"] == 0) == 40


def test_default_weights_edge_cases(spark):
    rows = [(None, "a"), (1, None), (1, None), (2, "")]
    df = frame(spark, rows).withColumn("_k", F.lit(1))
    m = mixing.mixed(df)
    assert set(df.columns) <= set(m.columns)
    assert {r["doc_id"] for r in m.collect()} <= {None, 1, 2}
    assert mixing.mixed(frame(spark, []).limit(0)).count() == 0


def test_whole_table(spark):
    from tests.conftest import SF_SMALL
    a = sorted(tuple(r) for r in mixing.query(spark, SF_SMALL).collect())
    assert a == sorted(tuple(r) for r in mixing.query(spark, SF_SMALL).collect()) and len(a) > 100


def test_a_tiny_source_does_not_end_the_mix(spark):
    import corpus_pipeline
    docs = spark.range(100_000).select(F.col("id").alias("doc_id"), F.lit("big").alias("source"))
    docs = docs.unionByName(spark.createDataFrame([(-1, "tiny")], docs.schema))
    m = corpus_pipeline.mix(spark, docs, "").agg(F.max("_slot").alias("last"), F.max(F.when(F.col("source") == "tiny", F.col("_epoch"))).alias("tiny")).first()
    assert m["last"] + 1 >= 6251 and m["tiny"] >= 5


def test_every_document_of_a_hot_source_comes(spark):
    import corpus_pipeline
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 19))
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), key.alias("source"))
    docs = docs.unionByName(spark.createDataFrame([(-1, "tiny")], docs.schema))
    m = corpus_pipeline.mix(spark, docs, "")
    assert docs.join(m, "doc_id", "left_anti").count() == 0
    assert m.select("doc_id", "_epoch").distinct().count() == m.count()
    per = m.groupBy("_slot").agg(F.count_distinct("source").alias("n"), F.count(F.lit(1)).alias("rows"))
    r = per.agg(F.count(F.lit(1)).alias("slots"), F.max("_slot").alias("last"), F.max("n").alias("n"), F.max("rows").alias("rows")).first()
    assert r["slots"] == r["last"] + 1 and r["n"] == 1 and r["rows"] <= 16


def test_decimal_weights_are_exact(spark):
    w = [0.0004, 0.3333, 0.6663]
    src = sources(spark, w)
    assert mixing.period_for(src) == 10_000
    got = mixing.pattern(mixing.shares(src, 10_000), 10_000).orderBy("slot").collect()
    done = Counter()
    for t, r in enumerate(got, 1):
        done[r["number"]] += 1
        if t % 97 == 0 or t == len(got):
            assert all(abs(done[i + 1] - x * t) < 1 for i, x in enumerate(w))
    assert mixing.period_for(sources(spark, [5, 3, 2])) == 10 and mixing.period_for(sources(spark, [2 ** 0.5, 3 ** 0.5])) == mixing.PERIOD


def test_more_sources_than_a_thousand(spark):
    n = 1200
    docs = spark.range(3 * n).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % n).alias("source"))
    m = mixing.mixed(docs, block_docs=1, max_epochs=None)
    assert docs.join(m, "doc_id", "left_anti").count() == 0
    per = m.groupBy("source").count().agg(F.min("count").alias("lo"), F.max("count").alias("hi")).first()
    assert per["hi"] - per["lo"] <= 1


def test_twin_on_a_skewed_table(spark):
    import duckdb
    from webmetrics.llm import oracles
    key = F.when(F.col("id") >= 9000, F.lit("hot")).when(F.col("id") == 7, F.lit("tiny")).otherwise(F.concat(F.lit("s"), F.col("id") % 5))
    docs = spark.range(120_000).select(F.col("id").alias("doc_id"), key.alias("source"))
    got = mixing.mixed(docs, max_epochs=None).select("doc_id", "source", "_slot", "_place", "_epoch")
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    rows = con.execute(oracles.MIX).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(rows) and len(rows) > 120_000 and max(r[4] for r in rows) > 4
