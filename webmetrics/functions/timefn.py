"""Time helpers.

All buckets are computed on epoch seconds, which is exact in UTC and keeps
the expression inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAIN_SECONDS = {"5min": 300, "hour": 3600, "day": 86400}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def bucket(ts, seconds: int) -> Column:
    """Start of the ``seconds``-wide bucket containing ``ts`` (UTC)."""
    s = F.unix_seconds(_c(ts).cast("timestamp"))
    return F.timestamp_seconds(s - F.pmod(s, F.lit(seconds)))


def bucket5(ts) -> Column:
    return bucket(ts, 300)


def start_of_hour(ts) -> Column:
    return bucket(ts, 3600)


def start_of_day(ts) -> Column:
    return bucket(ts, 86400)


def to_dt(x) -> _dt.datetime | None:
    """Accept datetime / ISO text; return a naive UTC datetime."""
    if x is None:
        return None
    if isinstance(x, str):
        x = _dt.datetime.fromisoformat(x)
    if isinstance(x, _dt.date) and not isinstance(x, _dt.datetime):
        x = _dt.datetime(x.year, x.month, x.day)
    if x.tzinfo is not None:
        x = x.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return x


def utc_lit(x) -> Column:
    """A timestamp literal for a (naive UTC) time, whatever the driver's time zone."""
    return F.timestamp_micros(F.lit((to_dt(x) - _dt.datetime(1970, 1, 1)) // _dt.timedelta(microseconds=1)))


def range_days(lo, hi) -> float | None:
    """Length of [lo, hi) in fractional days; None when either end is unset."""
    lo, hi = to_dt(lo), to_dt(hi)
    if lo is None or hi is None:
        return None
    return (hi - lo).total_seconds() / 86400.0


def granularity(lo, hi, day_over: float = 10) -> str:
    """'day' if the range exceeds ``day_over`` days, 'hour' if > 1 day, else '5min'.

    No range -> '5min' (quirk Q10).
    """
    d = range_days(lo, hi)
    if d is None:
        return "5min"
    if d > day_over:
        return "day"
    if d > 1:
        return "hour"
    return "5min"


def ceil_to(x, seconds: int) -> _dt.datetime:
    """Smallest bucket boundary >= x (x itself when already aligned)."""
    x = to_dt(x)
    epoch = _dt.datetime(1970, 1, 1)
    s = (x - epoch).total_seconds()
    q = -(-s // seconds) * seconds
    return epoch + _dt.timedelta(seconds=q)
