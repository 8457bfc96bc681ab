"""Broadcast guard: broadcast only behind a proven row bound."""

from webmetrics.plans.strategy import checked_broadcast, is_bounded


def _has_broadcast_hint(df) -> bool:
    return "broadcast" in df._jdf.queryExecution().logical().toString().lower()


def test_bounded_side_is_broadcast(spark):
    small = spark.range(10)
    assert is_bounded(small, 10) and not is_bounded(small, 9)
    assert _has_broadcast_hint(checked_broadcast(small, 100))


def test_unbounded_side_left_to_shuffle(spark):
    big = spark.range(1000)
    out = checked_broadcast(big, 999)
    assert not _has_broadcast_hint(out)
    assert big.join(out, "id").count() == 1000


def test_wide_rows_are_not_bounded(spark, monkeypatch):
    from webmetrics.plans import strategy
    monkeypatch.setattr(strategy, "DIM_MAX_BYTES", 1000)
    assert is_bounded(spark.range(20), 20) and not is_bounded(spark.range(21).selectExpr("repeat('x', 100) AS t"), 21)
