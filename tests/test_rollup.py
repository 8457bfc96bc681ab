"""FIXTURES 2.4: joins and rollups."""

import datetime as dt
import re

from pyspark.sql import functions as F

from webmetrics.operators import rollup

T0 = dt.datetime(2024, 1, 1, 0, 7, 31)
SES = "api_key string, site string, id string, ts timestamp, parent string, os string, " \
      "browser string, country_code string, city string"
SEC = "api_key string, site string, id string, ts timestamp, parent string, path string"
VIS = "api_key string, site string, id string, ts timestamp"


def frames(spark):
    vis = spark.createDataFrame([("k", "s", "v1", T0)], VIS)
    ses = spark.createDataFrame([("k", "s", "s1", T0, "v1", "Linux", "Firefox", "NAA", "C"),
                                 ("k", "s", "s2", T0, "v-missing", "iOS", "Safari", "NAB", "D"),
                                 ("k2", "s", "s3", T0, "v1", "iOS", "Safari", "NAB", "D")], SES)
    sec = spark.createDataFrame([("k", "s", "x1", T0, "s1", "/a"),
                                 ("k", "s", "x2", T0, "s2", "/b"),
                                 ("k", "s", "x3", T0, "s-missing", "/c"),
                                 ("k", "s", "x4", T0, "s3", "/d")], SEC)
    return vis, ses, sec


def test_section_combined(spark):
    vis, ses, sec = frames(spark)
    rows = {r.path: r for r in rollup.section_combined(sec, ses).collect()}
    assert set(rows) == {"/a", "/b"}  # missing session dropped; other tenant not joined
    assert rows["/a"].ts == dt.datetime(2024, 1, 1, 0, 5)
    assert rows["/a"].visitor == "v1" and rows["/a"].os == "Linux"


def test_hierarchy_needs_visitor(spark):
    vis, ses, sec = frames(spark)
    rows = rollup.hierarchy(sec, ses, vis).collect()
    assert [(r.visitor, r.session, r.section) for r in rows] == [("v1", "s1", "x1")]


def test_session_semi(spark):
    vis, ses, sec = frames(spark)
    assert sorted(r.id for r in rollup.session_semi(ses, sec).collect()) == ["s1", "s2"]  # s3: other tenant


def test_timeseries_partials_merge(spark):
    v = spark.createDataFrame([("k", "s", f"v{i}", T0 + dt.timedelta(seconds=i)) for i in range(5)], VIS)
    a = rollup.visitor_timeseries(v.where(F.col("id").isin("v0", "v1")))
    b = rollup.visitor_timeseries(v.where(~F.col("id").isin("v0", "v1")))
    m = rollup.merge_timeseries(a.unionByName(b)).collect()
    assert [(r.ts, r.visitors) for r in m] == [(dt.datetime(2024, 1, 1, 0, 5), 5)]
    assert rollup.merge_timeseries(rollup.merge_timeseries(a.unionByName(b))).first().visitors == 5


def test_daily_and_session_timeseries(spark):
    vis, ses, sec = frames(spark)
    fact = rollup.section_combined(sec, ses)
    d = rollup.daily(fact, "browser").collect()
    assert sorted((r.browser, r.page_views) for r in d) == [("Firefox", 1), ("Safari", 1)]
    t = rollup.daily(fact, None, with_visitors=True).first()
    assert (t.page_views, t.visitors) == (2, 2)
    st = rollup.session_timeseries(ses, vis).collect()
    assert len(st) == 1 and dict(st[0].os) == {"Linux": 1} and st[0].uniq_visitors == 1


def test_hierarchy_ids_exist_on_driver_data(spark):
    from webmetrics.plans.facts import driver_model

    from .conftest import SF_SMALL
    m = driver_model(spark, SF_SMALL)
    h = m.hierarchy
    assert h.count() > 0
    for col, table in [("visitor", m.visitor), ("session", m.session), ("section", m.section)]:
        ids = table.select("api_key", "site", F.col("id").alias(col))
        assert h.join(ids, ["api_key", "site", col], "left_anti").count() == 0, col
    # every fact row is a page view whose session exists; visitors <= page views per bucket
    f = m.section_combined
    assert f.count() == m.section.join(
        m.session.select("api_key", "site", F.col("id").alias("parent")), ["api_key", "site", "parent"]).count()


def test_daily_rollups_add_up_over_batches(spark, tmp_path):
    from webmetrics import schema as S
    from webmetrics.operators import report
    from webmetrics.sources import sinks
    rows = [("k", "s", f"2024-01-0{1 + i % 3} 0{i % 9}:00:00", f"/{i % 2}", f"v{i % 5}") for i in range(30)]
    fact = spark.createDataFrame(rows, "api_key string, site string, ts string, path string, visitor string")
    known = {"ts": "timestamp(ts)"} | {c: c for c in fact.columns if c != "ts"}
    fact = fact.selectExpr(*[f"{known.get(f.name, 'cast(null as ' + f.dataType.simpleString() + ')')} AS {f.name}"
                             for f in S.SECTION_COMBINED.fields])
    for batch in (0, 1, 0):
        sinks.write_table(fact.where(f"hour(ts) % 2 = {batch}"), f"{tmp_path}/section_combined/batch={batch}", "section_combined", "overwrite")
        sinks.write_daily(spark, str(tmp_path), batch, ("daily_by_path", "daily_total"))
    d = sinks.read_table(spark, f"{tmp_path}/daily_by_path", "daily_by_path", ("batch",))
    got = {tuple(r) for r in report.from_daily(d, "by_path", "path", ["k"], ["s"]).collect()}
    assert got == {("/0", 15), ("/1", 15)}
    t = sinks.read_table(spark, f"{tmp_path}/daily_total", "daily_total", ("batch",))
    assert report.from_daily(t, "total_visitors", None, ["k"], ["s"], with_visitors=True).first().visitors == 5


def test_page_views_are_sorted_by_id_first(spark):
    ids = spark.range(50).selectExpr("'k' AS api_key", "'s' AS site", "cast(id AS string) AS id", "timestamp'2024-01-01' AS ts",
                                     "cast(id % 7 AS string) AS parent", "'/' AS path", "'o' AS os", "'b' AS browser", "'c' AS country_code", "'t' AS city")
    fact = rollup.section_combined(ids, ids, "merge")
    sorts = re.findall(r"Sort \[(\w+?)#", fact._jdf.queryExecution().executedPlan().toString())
    assert sorts and set(sorts) == {"parent"}       # not by the tenant, whose rows are all alike
    assert fact.count() == 50
