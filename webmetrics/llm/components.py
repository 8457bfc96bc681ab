"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webmetrics.llm.blocks import discard, written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every node of an edge; component: its smallest reachable id.

    The tables of each round are written to the shared folder. The minimum of a
    node's neighbours is a pre-aggregated group, so a hub costs no single task;
    the number of rounds grows with the logarithm of the number of nodes.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = written(e, "edges")
    seen = _state(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionByName(least.where("m < u").select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        old, e = e, written(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")
        discard(old)
        now = _state(e)
        if now == seen:
            break
        seen = now
    return e.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("id"), F.col("v").alias("component"))


def _state(e: DataFrame):
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
