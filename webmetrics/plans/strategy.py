"""Join-strategy guards.

A side is broadcast only behind a proven size bound: a bounded read
(``limit(n + 1)``, which stops after n + 1 rows) shows it holds at most
``max_rows`` rows and, printed as JSON, ``DIM_MAX_BYTES`` bytes. Beyond the bound the join is left to the shuffle
path, where AQE re-plans with runtime statistics (and still converts to a
broadcast join when the *measured* shuffle output is small) and splits
skewed partitions.

Bound checks are memoised per logical plan (``semanticHash``) for
``CHECK_TTL_SECONDS``, like a dictionary with a refresh lifetime, so a
dimension used by several joins of one plan is counted once.
"""

from __future__ import annotations

import time
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Upper bounds for the dimension sides we broadcast.
DIM_MAX_ROWS = 2_000_000
DIM_MAX_BYTES = 64 << 20
CHECK_TTL_SECONDS = 60.0

_checked: dict[tuple, tuple[float, bool]] = {}


def _key(df: DataFrame, max_rows: int) -> tuple | None:
    try:
        return (df.sparkSession.sparkContext.applicationId, df.semanticHash(), max_rows)
    except Exception:  # pragma: no cover - e.g. Connect sessions
        return None


def is_bounded(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and DIM_MAX_BYTES bytes (reads at most max_rows + 1 rows)."""
    k = _key(df, max_rows)
    now = time.monotonic()
    if k is not None and k in _checked and now - _checked[k][0] < CHECK_TTL_SECONDS:
        return _checked[k][1]
    size = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    rows, total = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(size)).first()
    ok = rows <= max_rows and (total or 0) <= DIM_MAX_BYTES
    if k is not None:
        _checked[k] = (now, ok)
    return ok


def checked_broadcast(df: DataFrame, max_rows: int = DIM_MAX_ROWS) -> DataFrame:
    """``broadcast(df)`` if it is proven small (:func:`is_bounded`), else ``df`` unchanged."""
    return F.broadcast(df) if is_bounded(df, max_rows) else df


@contextmanager
def session_conf(spark: SparkSession, key: str, value: str):
    """A session setting for the jobs of a block; then as before."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
