"""Report time logic (H1-H9) and invariants."""

import datetime as dt

import pytest

from webmetrics.operators import report

FACT = "api_key string, site string, ts timestamp, path string, os string, browser string, " \
       "country_code string, city string, visitor string"
D = dt.datetime


@pytest.fixture(scope="module")
def fact(spark):
    rows = [
        ("k", "s", D(2024, 1, 1, 13, 0), "/a", "Linux", "Firefox", "NAA", "C", "v1"),
        ("k", "s", D(2024, 1, 2, 10, 0), "/b", "iOS", "Safari", "NAB", "D", "v2"),
        ("k", "s", D(2024, 1, 12, 10, 0), "/a", "iOS", "Safari", "NAB", "D", "v2"),
        ("k", "s", D(2024, 1, 15, 9, 0), "/c", "Linux", "Chrome", "NAA", "C", "v3"),
        ("other", "s", D(2024, 1, 2, 0, 0), "/a", "Linux", "Firefox", "NAA", "C", "v9"),
    ]
    return spark.createDataFrame(rows, FACT)


def pv(df, key):
    return {r[key]: r.page_views for r in df.collect()}


def test_tenant_filter_mandatory(fact):
    with pytest.raises(ValueError):
        report.by_os(fact, [], ["s"])


def test_no_range_all_time(fact):
    assert sum(pv(report.by_os(fact, ["k"], ["s"]), "os").values()) == 4


def test_day_truncation_drops_from_day(fact):
    # > 10 days, from = 12:00 on Jan 1 -> the whole of Jan 1 is dropped
    r = report.by_country(fact, ["k"], ["s"], D(2024, 1, 1, 12), D(2024, 1, 15, 6))
    assert sum(pv(r, "country_code").values()) == 3  # Jan 2, Jan 12 and (to-day included) Jan 15


def test_forcing_filter_uses_raw_time(fact):
    r = report.by_country(fact, ["k"], ["s"], D(2024, 1, 1, 12), D(2024, 1, 15, 6),
                          filters={"browser": ["Firefox", "Safari", "Chrome"]})
    assert sum(pv(r, "country_code").values()) == 3  # Jan 1 13:00, Jan 2, Jan 12


def test_by_path_os_does_not_force(fact):
    r = report.by_path(fact, ["k"], ["s"], D(2024, 1, 1, 12), D(2024, 1, 15, 6), {"os": ["Linux"]})
    assert pv(r, "path") == {"/c": 1}  # day-truncated: Jan 1 dropped, Jan 15 kept
    r = report.by_path(fact, ["k"], ["s"], D(2024, 1, 1, 12), D(2024, 1, 15, 6),
                       {"os": ["Linux"]}, time_mode="exact")
    assert pv(r, "path") == {"/a": 1}


def test_own_dimension_not_filtered(fact):
    r = report.by_os(fact, ["k"], ["s"], filters={"os": ["Linux"]})
    assert set(pv(r, "os")) == {"Linux", "iOS"}


def test_timeseries_grain_and_bucket_filter(fact):
    r = report.timeseries(fact, ["k"], ["s"], D(2024, 1, 1, 12), D(2024, 1, 15, 6))
    times = sorted(x.time for x in r.collect())
    assert times == [D(2024, 1, 2), D(2024, 1, 12), D(2024, 1, 15)]  # day grain on bucket start
    r = report.timeseries(fact, ["k"], ["s"], D(2024, 1, 1), D(2024, 1, 3))
    assert sorted(x.time for x in r.collect()) == [D(2024, 1, 1, 13), D(2024, 1, 2, 10)]


def test_total_visitors_one_row_on_empty(fact):
    r = report.total_visitors(fact, ["none"], ["s"]).collect()
    assert len(r) == 1 and r[0].visitors == 0


def test_invariants(fact):
    total = fact.where("api_key = 'k'").count()
    for name, dim in [("by_browser", "browser"), ("by_os", "os"), ("by_path", "path"), ("by_city", "city")]:
        assert sum(pv(report.REPORTS[name](fact, ["k"], ["s"]), dim).values()) == total
    for r in report.by_country(fact, ["k"], ["s"]).collect():
        assert r.visitors <= r.page_views


def test_hll_close_to_exact(spark):
    rows = [("k", "s", D(2024, 1, 1), "/", "o", "b", "c", "x", f"v{i % 3000}") for i in range(20000)]
    f = spark.createDataFrame(rows, FACT)
    exact = report.total_visitors(f, ["k"], ["s"]).first().visitors
    approx = report.total_visitors(f, ["k"], ["s"], distinct="hll").first().visitors
    assert exact == 3000 and abs(approx - exact) <= 3 * 0.0163 * exact  # 3 x rsd of lgK=12


def test_visitor_timeseries(spark):
    v = spark.createDataFrame([("k", "s", D(2024, 1, 1, 0, 5), 2), ("k", "s", D(2024, 1, 1, 0, 5), 3),
                               ("k", "s", D(2024, 1, 1, 1, 5), 1)], "api_key string, site string, ts timestamp, visitors long")
    r = report.visitor_timeseries(v, ["k"], ["s"], D(2024, 1, 1), D(2024, 1, 3))
    assert sorted((x.ts, x.visitors) for x in r.collect()) == [(D(2024, 1, 1, 0), 5), (D(2024, 1, 1, 1), 1)]
    with pytest.raises(ValueError):
        report.visitor_timeseries(v, ["k"], ["s"], None, None)


def test_rollup_answers_equal_fact(fact):
    from webmetrics.operators import rollup
    d = rollup.daily(fact, "os", sketch=True)
    a = pv(report.from_daily(d, "by_os", "os", ["k"], ["s"]), "os")
    assert a == pv(report.by_os(fact, ["k"], ["s"]), "os")
    r = report.from_daily(rollup.daily(fact, None, sketch=True), "total_visitors", None, ["k"], ["s"],
                          with_visitors=True).first()
    assert r.visitors == 3 and r.page_views == 4
    with pytest.raises(ValueError):  # a filter on another dimension needs the fact
        report.from_daily(d, "by_os", "os", ["k"], ["s"], filters={"path": ["/a"]})


def test_answer_dispatch(fact):
    from webmetrics.operators import rollup
    rolls = {"os": rollup.daily(fact, "os"), "country_code": rollup.daily(fact, "country_code", sketch=True)}
    a = report.answer("by_os", fact, ["k"], ["s"], rollups=rolls)
    assert pv(a, "os") == pv(report.by_os(fact, ["k"], ["s"]), "os")
    # a filter on another dimension falls back to the fact
    b = report.answer("by_os", fact, ["k"], ["s"], filters={"path": ["/a"]}, rollups=rolls)
    assert pv(b, "os") == {"Linux": 1, "iOS": 1}
    c = report.answer("by_country", fact, ["k"], ["s"], distinct="hll", rollups=rolls)
    assert {r.country_code: r.visitors for r in c.collect()} == {"NAA": 2, "NAB": 1}
