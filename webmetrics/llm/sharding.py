"""Sharding by a two-pass external shuffle; its law is `rows`.

First pass: every record is scattered into one of many buckets by a seeded hash of its id, so
that a bucket holds about ``bucket_bytes`` whatever the size of the table and the order of
its rows. Second pass: one bucket at a time is put in a fixed order, shuffled by Fisher and
Yates with draws that depend on the seed, the bucket and the position only, and written. The
buckets one after the other are a uniform permutation of all records; it is cut
into shards whose numbers of rows differ by at most one. Where a bucket's rows start in the
permutation follows from the numbers of rows of the buckets, counted beforehand on the
narrow columns (running sums in two levels, no single task sees all buckets).

Records with equal ids or without an id are numbered first (a written table), so that a
third of all rows under one id is scattered like any other. Equal texts are not kept
together: no group of copies meets in a task.

Shards are folders ``shard=<n>`` of a Parquet table, rows in the order of ``slot`` within a
file. A lost executor's buckets are shuffled again with the same draws. Defined results: a
null or empty text has no bytes; repeated rows are records of their own; an empty table gives
no rows; other columns are kept whatever their names (those of ADDED are replaced).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webmetrics.llm.blocks import scratch, step
from webmetrics.llm.frames import ship
from webmetrics.llm.minhash import KEY, keyed

SHARDS, SEED = 24, 11
BUCKET_BYTES = 16 << 20
ADDED = ("shard", "slot")
_GROUP = 4096       # buckets whose running sums one task computes


def _draw(*parts: Column) -> Column:
    """52 bits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 13), 16, 10).cast("long")


def size(text: str) -> Column:
    """Bytes of a record: its text in UTF-8 and 8 more."""
    return (F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)) + 8).cast("long")


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A permutation of n positions; draws are 52 bits of an MD5 each, so that any engine repeats them."""
    out = list(range(n))
    for i in range(n - 1, 0, -1):
        j = int(hashlib.md5(f"{seed}:{bucket}:{i}".encode()).hexdigest()[:13], 16) % (i + 1)
        out[i], out[j] = out[j], out[i]
    return np.array(out, np.int64)


def starts(counts: DataFrame) -> DataFrame:
    """(bucket, n) -> (bucket, first): where each bucket's rows start."""
    g = counts.withColumn("g", F.expr(f"bucket div {_GROUP}"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inner = g.withColumn("here", before(Window.partitionBy("g").orderBy("bucket")))
    outer = g.groupBy("g").agg(F.sum("n").alias("n")).withColumn("ahead", before(Window.orderBy("g"))).drop("n")
    return inner.join(outer, "g").select("bucket", (F.col("here") + F.col("ahead")).alias("first"))


def sharded(docs: DataFrame, ident: str = "doc_id", text: str = "text", shards: int = SHARDS, seed: int = SEED,
            bucket_bytes: int = BUCKET_BYTES, path: str | None = None) -> DataFrame:
    """Writes the records into shards below ``path`` (a new folder in the cluster's shared
    one if None) and returns the table: all columns, shard and slot."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.drop(*ADDED)
    numbered = keyed(docs, ident)
    rows = docs if numbered is None else numbered
    key = F.col(f"`{ident}`").cast("string") if numbered is None else F.col(KEY).cast("string")
    n_rows, n_bytes = rows.agg(F.count(F.lit(1)), F.sum(size(text))).first()
    n_buckets = max(1, -(-(n_bytes or 0) // bucket_bytes))
    drawn = _draw(F.lit(str(seed)), key)
    inner = [f"c{i}" for i in range(len(docs.columns))]
    flat = rows.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, inner, strict=True)],
                       drawn.alias("draw"), key.alias("key"), F.pmod(drawn, F.lit(n_buckets)).alias("bucket"))
    first = starts(rows.select(F.pmod(drawn, F.lit(n_buckets)).alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n")))

    def run(bucket, here: pa.Table, at: pa.Table) -> pa.Table:
        fixed = pc.sort_indices(here.select(["draw", "key"]), [("draw", "ascending"), ("key", "ascending")]).to_numpy()
        here = here.take(pa.array(fixed[fisher_yates(here.num_rows, seed, bucket[0].as_py())]))
        start = at["first"][0].as_py()
        rank = np.arange(start, start + here.num_rows)
        shard = rank * shards // n_rows
        slot = rank - (shard * n_rows + shards - 1) // shards
        return here.select(inner).append_column("shard", pa.array(shard, pa.int32())).append_column("slot", pa.array(slot, pa.int64()))

    kinds = ", ".join(f"{n} {flat.schema[n].dataType.simpleString()}" for n in inner)
    out = flat.groupBy("bucket").cogroup(first.groupBy("bucket")).applyInArrow(run, f"{kinds}, shard int, slot long")
    out = out.sortWithinPartitions("shard", "slot").select(*[F.col(n).alias(c) for n, c in zip(inner, docs.columns, strict=True)], *ADDED)
    path = path or scratch(spark, "shards")
    with step(spark):
        out.write.partitionBy("shard").parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def query(spark, sf_dir: str) -> DataFrame:
    """op11: all ``documents`` in 24 shards."""
    t = sharded(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return t.select("doc_id", size("text").alias("size"), crc.alias("text_crc32"), F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
                    F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
