"""Hierarchical joins and time rollups.

Joins on the event hierarchy are equi joins on (api_key, site, id): a few
tenants hold most rows, so the id is always part of the shuffle key and a
tenant never lands in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webmetrics.functions.timefn import bucket5, start_of_day, start_of_hour  # noqa: F401

FACT_COLS = ("api_key", "site", "ts", "path", "os", "browser", "country_code", "city", "visitor")


def section_combined(section: DataFrame, session: DataFrame, join_hint: str | None = None) -> DataFrame:
    """E1 + F3: page views joined with their session's attributes, 5-minute ts.

    Inner join on (api_key, site, parent = session.id); sections whose
    session is absent are dropped, as in the reference. ``join_hint``
    (e.g. 'merge', E7) forces a strategy; by default AQE chooses.
    """
    s = session.select("api_key", "site", F.col("id").alias("parent"), "os", "browser",
                       "country_code", "city", F.col("parent").alias("visitor"))
    if join_hint:
        s = s.hint(join_hint)
    p = section.select("api_key", "site", "parent", "ts", "path")
    # The id first: the first 8 bytes of the first key decide most comparisons of a sort,
    # and a tenant's are all alike.
    return p.join(s, ["parent", "api_key", "site"], "inner").select(
        "api_key", "site", bucket5("ts").alias("ts"), "path", "os", "browser",
        "country_code", "city", "visitor")


def session_semi(session: DataFrame, section: DataFrame) -> DataFrame:
    """Sessions that are the parent of at least one page view (left semi)."""
    parents = section.select("api_key", "site", F.col("parent").alias("id"))
    return session.join(parents, ["api_key", "site", "id"], "left_semi")


def hierarchy(section: DataFrame, session: DataFrame, visitor: DataFrame) -> DataFrame:
    """One row per page view with its session and visitor ids (inner chain)."""
    sec = section.select("api_key", "site", F.col("id").alias("section"),
                         F.col("parent").alias("session"), "ts")
    ses = session.select("api_key", "site", F.col("id").alias("session"),
                         F.col("parent").alias("visitor"))
    vis = visitor.select("api_key", "site", F.col("id").alias("visitor"))
    return (sec.join(ses, ["api_key", "site", "session"])
               .join(vis, ["api_key", "site", "visitor"])
               .select("api_key", "site", "visitor", "session", "section", "ts"))


def session_visitor(session: DataFrame, visitor: DataFrame) -> DataFrame:
    """Sessions whose visitor exists (3-key inner join)."""
    vis = visitor.select("api_key", "site", F.col("id").alias("parent"))
    return session.join(vis, ["api_key", "site", "parent"])


def visitor_timeseries(visitor: DataFrame) -> DataFrame:
    """visitors per (api_key, site, 5-minute bucket) as re-summable partial sums."""
    return (visitor.groupBy("api_key", "site", bucket5("ts").alias("ts"))
                   .agg(F.count(F.lit(1)).alias("visitors")))


def merge_timeseries(ts_df: DataFrame) -> DataFrame:
    """merge partial rows with equal keys (sum of the partial sums)."""
    return (ts_df.groupBy("api_key", "site", "ts")
                 .agg(F.sum("visitors").cast("long").alias("visitors")))


def session_timeseries(session: DataFrame, visitor: DataFrame) -> DataFrame:
    """hourly per (api_key, site, country): os and browser count maps,
    session count and distinct visitors, over sessions whose visitor exists.

    One pass: GROUPING SETS over (keys, os), (keys, browser) and (keys)
    computes the per-value counts and the totals together; the count maps
    and totals are then put together in one aggregate over these small rows (as
    many as distinct os / browser values), so no group ever collects raw rows.
    """
    keys = ["api_key", "site", "ts_bin", "country_code"]
    sv = session_visitor(session, visitor).select(
        "api_key", "site", start_of_hour("ts").alias("ts_bin"), "country_code", "os",
        "browser", "parent")
    g = sv.groupingSets([[*keys, "os"], [*keys, "browser"], keys], *keys, "os", "browser").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("parent").alias("uniq"),
        F.grouping_id().alias("gid"))
    # grouping_id bits (keys, os, browser): os set -> 1 (browser aggregated),
    # browser set -> 2, totals -> 3
    def count_map(col: str, gid: int):
        entry = F.when(F.col("gid") == gid, F.struct(F.col(col), F.col("n")))
        return F.map_from_entries(F.array_sort(F.collect_list(entry))).alias(col)

    def total(col: str):
        return F.max(F.when(F.col("gid") == 3, F.col(col)))

    return g.groupBy(*keys).agg(count_map("os", 1), count_map("browser", 2), total("n").alias("num"),
                                total("uniq").alias("uniq_visitors"))


def daily(fact: DataFrame, dim: str | None = None, with_visitors: bool = False,
          sketch: bool = False) -> DataFrame:
    """Daily page views per (api_key, site, day[, dim]) [+ distinct visitors].

    ``sketch=True`` adds ``visitors_sketch``, a mergeable HLL sketch, so
    distinct visitors over several days can be answered from the rollup
    (``hll_union_agg``), which plain per-day counts cannot.
    """
    keys = ["api_key", "site", start_of_day("ts").alias("day")] + ([dim] if dim else [])
    aggs = [F.count(F.lit(1)).alias("page_views")]
    if with_visitors:
        aggs.append(F.count_distinct("visitor").alias("visitors"))
    if sketch:
        aggs.append(F.hll_sketch_agg("visitor", 12).alias("visitors_sketch"))
    return fact.groupBy(*keys).agg(*aggs)
