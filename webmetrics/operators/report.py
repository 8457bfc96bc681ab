"""Parameterised reporting datasets (G1-G8) over the facts, with H1-H9.

Every report is one scan of a fact with conditional predicates and a
two-phase (partial + final) hash aggregate. Time predicates are rewritten
into exact ranges on the raw ``ts`` column so they reach the Parquet scan:

  start_of_day(ts) >= lo   <=>  ts >= ceil_day(lo)
  bucket_g(ts)     <  hi   <=>  ts <  ceil_g(hi)
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webmetrics import schema as S
from webmetrics.functions.timefn import GRAIN_SECONDS, bucket, ceil_to, granularity, range_days, to_dt, utc_lit

DISTINCT_MODES = ("exact", "hll", "approx")


def _tenant(df: DataFrame, api_keys, sites) -> DataFrame:
    """H1: mandatory tenant filter; an empty list is an error."""
    if not api_keys or not sites:
        raise ValueError("api_keys and sites must be non-empty lists")
    return df.where(F.col("api_key").isin(list(api_keys)) & F.col("site").isin(list(sites)))


def _dims(df: DataFrame, name: str, filters: dict | None) -> DataFrame:
    """H2/H9: IN filter per populated dimension the report emits (never its own)."""
    for d in S.REPORT_FILTERS[name]:
        vals = (filters or {}).get(d)
        if vals:
            df = df.where(F.col(d).isin(list(vals)))
    return df


def _range(ts: Column, lo, hi, seconds: int = 1, df: DataFrame | None = None) -> Column:
    """``lo <= ts < hi`` after aligning both ends up to the grain. On a stored
    table partitioned by ``event_date`` the matching date range is added, so
    partitions outside it are pruned (a ts predicate alone cannot prune)."""
    lo, hi = to_dt(lo), to_dt(hi)
    if seconds > 1:
        lo, hi = ceil_to(lo, seconds), ceil_to(hi, seconds)
    p = (ts >= utc_lit(lo)) & (ts < utc_lit(hi))
    if df is not None and "event_date" in df.columns and hi > lo:
        last = hi - _dt.timedelta(microseconds=1)
        p = p & (F.col("event_date") >= F.lit(lo.date())) & (F.col("event_date") <= F.lit(last.date()))
    return p


def time_predicate(name: str, start, end, filters: dict | None,
                   time_mode: str = "reference", df: DataFrame | None = None) -> Column | None:
    """H3-H5: half-open range on raw ts, or day-truncated comparison when the
    range exceeds 10 days and no forcing dimension filter is set."""
    if start is None or end is None:
        return None
    if time_mode not in ("reference", "exact"):
        raise ValueError(f"time_mode {time_mode!r}")
    forced = any((filters or {}).get(d) for d in S.FORCE_RAW[name])
    if time_mode == "exact" or forced or range_days(start, end) <= 10:
        return _range(F.col("ts"), start, end, 1, df)
    return _range(F.col("ts"), start, end, GRAIN_SECONDS["day"], df)


def _visitors(distinct: str) -> Column:
    if distinct == "exact":
        return F.count_distinct("visitor").alias("visitors")
    if distinct == "hll":
        return F.hll_sketch_estimate(F.hll_sketch_agg("visitor", 12)).alias("visitors")
    if distinct == "approx":
        return F.approx_count_distinct("visitor", 0.01).alias("visitors")
    raise ValueError(f"distinct {distinct!r}")


def _page_views() -> Column:
    return F.count(F.lit(1)).alias("page_views")


def _filtered(fact, name, api_keys, sites, start, end, filters, time_mode) -> DataFrame:
    df = _tenant(fact, api_keys, sites)
    p = time_predicate(name, start, end, filters, time_mode, fact)
    if p is not None:
        df = df.where(p)
    return _dims(df, name, filters)


def by_dimension(fact: DataFrame, name: str, dim: str, api_keys, sites, start=None, end=None,
                 filters: dict | None = None, time_mode: str = "reference",
                 with_visitors: bool = False, distinct: str = "exact") -> DataFrame:
    df = _filtered(fact, name, api_keys, sites, start, end, filters, time_mode)
    aggs = [_page_views()] + ([_visitors(distinct)] if with_visitors else [])
    return df.groupBy(dim).agg(*aggs)


def by_country(fact, api_keys, sites, start=None, end=None, filters=None,
               time_mode="reference", distinct="exact") -> DataFrame:
    """G1: country_code -> page_views, visitors."""
    return by_dimension(fact, "by_country", "country_code", api_keys, sites, start, end,
                        filters, time_mode, True, distinct)


def by_browser(fact, api_keys, sites, start=None, end=None, filters=None, time_mode="reference"):
    """Browser -> page_views."""
    return by_dimension(fact, "by_browser", "browser", api_keys, sites, start, end, filters, time_mode)


def by_os(fact, api_keys, sites, start=None, end=None, filters=None, time_mode="reference"):
    """Os -> page_views."""
    return by_dimension(fact, "by_os", "os", api_keys, sites, start, end, filters, time_mode)


def by_path(fact, api_keys, sites, start=None, end=None, filters=None, time_mode="reference"):
    """Path -> page_views."""
    return by_dimension(fact, "by_path", "path", api_keys, sites, start, end, filters, time_mode)


def by_city(fact, api_keys, sites, start=None, end=None, filters=None, time_mode="reference"):
    """City -> page_views."""
    return by_dimension(fact, "by_city", "city", api_keys, sites, start, end, filters, time_mode)


def total_visitors(fact, api_keys, sites, start=None, end=None, filters=None,
                   time_mode="reference", distinct="exact") -> DataFrame:
    """One row with the distinct visitors (one row even on empty input)."""
    df = _filtered(fact, "total_visitors", api_keys, sites, start, end, filters, time_mode)
    return df.agg(_visitors(distinct))


def timeseries(fact, api_keys, sites, start=None, end=None, filters=None,
               distinct="exact") -> DataFrame:
    """Time bucket (day / hour / 5 min by range length) -> page_views, visitors.

    The filter applies to the bucket start (H8), rewritten to raw ts.
    """
    g = GRAIN_SECONDS[granularity(start, end, 10)]
    df = _tenant(fact, api_keys, sites)
    if start is not None and end is not None:
        df = df.where(_range(F.col("ts"), start, end, g, fact))
    df = _dims(df, "timeseries", filters)
    return df.groupBy(bucket("ts", g).alias("time")).agg(_page_views(), _visitors(distinct))


def visitor_timeseries(vts: DataFrame, api_keys, sites, start, end,
                       merge_tenants: bool = False) -> DataFrame:
    """Re-summed visitor partial sums per bucket (day if > 30 days, hour if
    > 1 day, else 5 min). The range is mandatory and applies to the bucket.
    Returns api_key, site, ts, visitors (quirk Q9), or ts, visitors merged."""
    if start is None or end is None:
        raise ValueError("visitor_timeseries needs start and end")
    g = GRAIN_SECONDS[granularity(start, end, 30)]
    df = _tenant(vts, api_keys, sites).where(_range(F.col("ts"), start, end, g, vts))
    keys = [] if merge_tenants else ["api_key", "site"]
    return (df.groupBy(*keys, bucket("ts", g).alias("ts"))
              .agg(F.sum("visitors").cast("long").alias("visitors")))


REPORTS = {
    "by_country": by_country, "by_browser": by_browser, "by_os": by_os,
    "by_path": by_path, "by_city": by_city, "total_visitors": total_visitors,
    "timeseries": timeseries,
}


# --------------------------------------------------------------------------- rollups

def rollup_applies(name: str, dim: str | None, start, end, filters: dict | None,
                   time_mode: str = "reference") -> bool:
    """True when a daily rollup of ``dim`` answers the report exactly: no
    filter on another dimension, and a time predicate that is day-aligned
    (no range, the reference's day-truncated mode, or midnight bounds)."""
    if any((filters or {}).get(d) for d in S.REPORT_FILTERS[name]):
        return False
    if start is None or end is None:
        return True
    lo, hi = to_dt(start), to_dt(end)
    aligned = lo == ceil_to(lo, 86400) and hi == ceil_to(hi, 86400)
    if aligned:
        return True
    forced = any((filters or {}).get(d) for d in S.FORCE_RAW[name])
    return time_mode == "reference" and not forced and range_days(start, end) > 10


def from_daily(daily: DataFrame, name: str, dim: str | None, api_keys, sites, start=None, end=None,
               filters: dict | None = None, time_mode: str = "reference",
               with_visitors: bool = False) -> DataFrame:
    """Answer a report from a daily rollup (``rollup.daily``) instead of the fact.

    Page views are re-summed; distinct visitors come from the union of the
    daily HLL sketches (approximate). Raises ValueError when the rollup cannot
    answer the request exactly (see :func:`rollup_applies`).
    """
    if not rollup_applies(name, dim, start, end, filters, time_mode):
        raise ValueError("daily rollup cannot answer this request exactly")
    df = _tenant(daily, api_keys, sites)
    if start is not None and end is not None:
        df = df.where(_range(F.col("day"), start, end, GRAIN_SECONDS["day"]))
    aggs = [F.sum("page_views").cast("long").alias("page_views")]
    if with_visitors:
        aggs.append(F.hll_sketch_estimate(F.hll_union_agg("visitors_sketch")).alias("visitors"))
    return df.groupBy(dim).agg(*aggs) if dim else df.agg(*aggs)


DIM_OF = {"by_country": "country_code", "by_browser": "browser", "by_os": "os", "by_path": "path",
          "by_city": "city", "total_visitors": None}


def answer(name: str, fact: DataFrame, api_keys, sites, start=None, end=None,
           filters: dict | None = None, time_mode: str = "reference", distinct: str = "exact",
           rollups: dict | None = None) -> DataFrame:
    """One entry point for G1 and G3-G7 (``use_rollup``): answer from a daily
    rollup of the report's dimension when one is given and can answer
    (:func:`rollup_applies`; distinct visitors only as HLL), else scan the fact."""
    dim = DIM_OF[name]
    with_visitors = name in ("by_country", "total_visitors")
    daily = (rollups or {}).get(dim or "total")
    if (daily is not None and rollup_applies(name, dim, start, end, filters, time_mode)
            and (not with_visitors or (distinct == "hll" and "visitors_sketch" in daily.columns))):
        out = from_daily(daily, name, dim, api_keys, sites, start, end, filters, time_mode, with_visitors)
        return out.drop("page_views") if name == "total_visitors" else out
    fn = REPORTS[name]
    if with_visitors:
        return fn(fact, api_keys, sites, start, end, filters, time_mode, distinct)
    return fn(fact, api_keys, sites, start, end, filters, time_mode)
