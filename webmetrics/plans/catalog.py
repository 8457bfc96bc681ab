"""Registered queries: Spark builders and their DuckDB oracle SQL.

Each Spark builder takes (spark, sf_dir) and returns a DataFrame computed
from the driver's tables over their whole content. Column names match the
oracle SQL exactly.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webmetrics.operators import enrich, report, rollup
from webmetrics.plans import oracle as O
from webmetrics.plans import oracle_synth as SY
from webmetrics.plans.facts import Model, driver_model

KEYS = ["key-0", "key-1", "key-2"]
SITES = ["site0.example.com", "site1.example.com", "site2.example.com"]

SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        SPARK[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def _m(spark: SparkSession, sf_dir: str) -> Model:
    return driver_model(spark, sf_dir)


# ----------------------------------------------------------------- routing C1-C4

@register("route_visitor", O.with_model("SELECT api_key, site, id, ts FROM visitor"))
def route_visitor(spark, sf_dir):
    return _m(spark, sf_dir).visitor.select("api_key", "site", "id", "ts")


@register("route_session", O.with_model(
    "SELECT api_key, site, id, ts, parent, user_agent, ipv4 FROM session_raw"))
def route_session(spark, sf_dir):
    from webmetrics.operators import route
    m = _m(spark, sf_dir)
    return route.sessions(m.event, m.sources).select(
        "api_key", "site", "id", "ts", "parent", "user_agent", "ipv4")


@register("route_section", O.with_model(
    "SELECT api_key, site, id, ts, parent, path, query, fragment, title FROM section"))
def route_section(spark, sf_dir):
    return _m(spark, sf_dir).section.select(
        "api_key", "site", "id", "ts", "parent", "path", "query", "fragment", "title")


@register("route_click", O.with_model("SELECT api_key, site, id, ts, parent FROM click"))
def route_click(spark, sf_dir):
    return _m(spark, sf_dir).click


@register("url_parts", O.with_model(
    "SELECT DISTINCT location, path, query, fragment FROM section"))
def url_parts(spark, sf_dir):
    return _m(spark, sf_dir).section.select(
        F.col("attrs")["location"].alias("location"), "path", "query", "fragment").distinct()


# ----------------------------------------------------------------- enrichment D2-D9

@register("ua_browser", O.with_model(
    "SELECT DISTINCT user_agent, browser, browser_version FROM session"))
def ua_browser(spark, sf_dir):
    return _m(spark, sf_dir).session.select("user_agent", "browser", "browser_version").distinct()


@register("ua_os", O.with_model("SELECT DISTINCT user_agent, os, os_version FROM session"))
def ua_os(spark, sf_dir):
    return _m(spark, sf_dir).session.select("user_agent", "os", "os_version").distinct()


@register("ua_device", O.with_model(
    "SELECT DISTINCT user_agent, device_brand, device_model FROM session"))
def ua_device(spark, sf_dir):
    return _m(spark, sf_dir).session.select("user_agent", "device_brand", "device_model").distinct()


@register("ua_preview_top20", O.with_model(
    "SELECT user_agent, device_brand, device_model, os, os_version, browser, browser_version "
    "FROM session ORDER BY user_agent LIMIT 20"))
def ua_preview_top20(spark, sf_dir):
    return enrich.ua_preview(_m(spark, sf_dir).session, 20)


@register("geo_ip_range", O.with_model(
    "SELECT DISTINCT ipv4, country_code, state, city FROM session"))
def geo_ip_range(spark, sf_dir):
    return _m(spark, sf_dir).session.select("ipv4", "country_code", "state", "city").distinct()


@register("geo_unknown_default", O.with_model(
    "SELECT api_key, site, id, ipv4, country_code, state, city FROM session "
    "WHERE country_code = 'unknown'"))
def geo_unknown_default(spark, sf_dir):
    s = _m(spark, sf_dir).session
    return s.where(F.col("country_code") == "unknown").select(
        "api_key", "site", "id", "ipv4", "country_code", "state", "city")


@register("session_enriched", O.with_model(
    "SELECT api_key, site, id, ts, parent, device_brand, device_model, os, os_version, "
    "browser, browser_version, user_agent, ipv4, country_code, state, city FROM session"))
def session_enriched(spark, sf_dir):
    return _m(spark, sf_dir).session.drop("attrs", "ipv6")


# ----------------------------------------------------------------- joins E1-E3

@register("section_combined", O.with_model(
    "SELECT api_key, site, ts, path, os, browser, country_code, city, visitor FROM fact"))
def section_combined(spark, sf_dir):
    return _m(spark, sf_dir).section_combined


@register("session_semi", O.with_model(
    "SELECT api_key, site, id, ts FROM session s WHERE EXISTS (SELECT 1 FROM section x "
    "WHERE x.api_key = s.api_key AND x.site = s.site AND x.parent = s.id)"))
def session_semi(spark, sf_dir):
    m = _m(spark, sf_dir)
    return rollup.session_semi(m.session, m.section).select("api_key", "site", "id", "ts")


@register("hierarchy", O.with_model(
    "SELECT x.api_key, x.site, v.id AS visitor, s.id AS session, x.id AS section, x.ts "
    "FROM section x JOIN session s ON s.id = x.parent AND s.api_key = x.api_key AND s.site = x.site "
    "JOIN visitor v ON v.id = s.parent AND v.api_key = s.api_key AND v.site = s.site"))
def hierarchy(spark, sf_dir):
    return _m(spark, sf_dir).hierarchy


# ----------------------------------------------------------------- rollups F1-F11

@register("visitor_timeseries_state", O.with_model("SELECT api_key, site, ts, visitors FROM vts"))
def visitor_timeseries_state(spark, sf_dir):
    return _m(spark, sf_dir).visitor_timeseries


@register("visitor_timeseries_merge", O.with_model("SELECT api_key, site, ts, visitors FROM vts"))
def visitor_timeseries_merge(spark, sf_dir):
    """partial sums from two separately rolled-up halves merge to F1."""
    v = _m(spark, sf_dir).visitor
    half = F.substring("id", 36, 1).isin(*"02468ace")
    parts = rollup.visitor_timeseries(v.where(half)).unionByName(
        rollup.visitor_timeseries(v.where(~half)))
    return rollup.merge_timeseries(parts)


_DAILY_SQL = ("SELECT api_key, site, date_trunc('day', ts) AS day{dim}, count(*) AS page_views{vis} "
              "FROM fact GROUP BY api_key, site, date_trunc('day', ts){dim}")

for _name, _dim, _vis in [("daily_by_browser", "browser", False), ("daily_by_city", "city", False),
                          ("daily_by_country", "country_code", True), ("daily_by_os", "os", False),
                          ("daily_by_path", "path", False), ("daily_total", None, True)]:
    def _mk(dim=_dim, vis=_vis):
        def fn(spark, sf_dir):
            return rollup.daily(_m(spark, sf_dir).section_combined, dim, vis)
        return fn
    register(_name, O.with_model(_DAILY_SQL.format(
        dim=f", {_dim}" if _dim else "",
        vis=", count(DISTINCT visitor) AS visitors" if _vis else "")))(_mk())


@register("session_timeseries", O.with_model(
    "SELECT api_key, site, ts_bin, country_code, num, uniq_visitors, os, browser FROM ("
    " SELECT api_key, site, ts_bin, country_code, count(*) AS num, count(DISTINCT parent) AS uniq_visitors FROM sv"
    " GROUP BY 1, 2, 3, 4) b"
    " JOIN (SELECT api_key, site, ts_bin, country_code, string_agg(os || ':' || n, ',' ORDER BY os) AS os FROM ("
    "   SELECT api_key, site, ts_bin, country_code, os, count(*) AS n FROM sv"
    "   GROUP BY 1, 2, 3, 4, 5) GROUP BY 1, 2, 3, 4) o USING (api_key, site, ts_bin, country_code)"
    " JOIN (SELECT api_key, site, ts_bin, country_code, string_agg(browser || ':' || n, ',' ORDER BY browser) AS browser FROM ("
    "   SELECT api_key, site, ts_bin, country_code, browser, count(*) AS n FROM sv"
    "   GROUP BY 1, 2, 3, 4, 5) GROUP BY 1, 2, 3, 4) br USING (api_key, site, ts_bin, country_code)", """
    sv AS (SELECT s.*, date_trunc('hour', s.ts) AS ts_bin FROM session s WHERE EXISTS (
      SELECT 1 FROM visitor v WHERE v.id = s.parent AND v.api_key = s.api_key AND v.site = s.site
      AND right(v.id, 1) NOT IN ('0', '4', '8')))"""))
def session_timeseries(spark, sf_dir):
    """F5/E8 with some visitors missing (by the last digit of their id)."""
    m = _m(spark, sf_dir)
    st = rollup.session_timeseries(m.session, m.visitor.where(~F.substring("id", -1, 1).isin("0", "4", "8")))

    def flat(c):
        return F.array_join(F.transform(F.array_sort(F.map_entries(c)),
                                        lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))), ",")
    return st.select("api_key", "site", "ts_bin", "country_code", "num", "uniq_visitors",
                     flat(F.col("os")).alias("os"), flat(F.col("browser")).alias("browser"))


# ----------------------------------------------------------------- reports G1-G8

# The oracles state for each case the branch it must take: no rule is shared with the engine.
_TENANT = ("api_key IN ('key-0', 'key-1', 'key-2') "
           "AND site IN ('site0.example.com', 'site1.example.com', 'site2.example.com')")
_RAW = "ts >= TIMESTAMP '{}' AND ts < TIMESTAMP '{}'"
_DAYS = "date_trunc('day', ts) >= TIMESTAMP '{}' AND date_trunc('day', ts) < TIMESTAMP '{}'"
_BUCKET = {"day": "date_trunc('day', ts)", "hour": "date_trunc('hour', ts)",
           "5 minutes": "epoch_ms(epoch_ms(ts) // 300000 * 300000)"}


def _report_sql(select: str, where: str = "true", group: str = "") -> str:
    return O.with_model(f"SELECT {select} FROM fact WHERE {_TENANT} AND {where} {group and 'GROUP BY ' + group}")


def _buckets_sql(select: str, table: str, name: str, bucket: str, lo: str, hi: str, group: str, where: str = "true") -> str:
    return O.with_model(f"SELECT {select} FROM (SELECT * EXCLUDE (ts), {_BUCKET[bucket]} AS {name} FROM {table}) WHERE {_TENANT} "
                        f"AND {name} >= TIMESTAMP '{lo}' AND {name} < TIMESTAMP '{hi}' AND {where} GROUP BY {group}")


_VIEWS, _BOTH = "count(*) AS page_views", "count(*) AS page_views, count(DISTINCT visitor) AS visitors"
REPORT_SQL = {
    "report_by_country": _report_sql(f"country_code, {_BOTH}", group="country_code"),
    # five days: times as they are
    "report_by_browser": _report_sql(f"browser, {_VIEWS}", _RAW.format("2024-01-04 00:00:00", "2024-01-09 00:00:00"), "browser"),
    "report_by_os": _report_sql(f"os, {_VIEWS}", group="os"),
    # over ten days, and a filter on os does not force raw times
    "report_by_path": _report_sql(f"path, {_VIEWS}", _DAYS.format("2024-01-02 06:00:00", "2024-01-25 18:00:00")
                                  + " AND os IN ('Android', 'iOS', 'Windows')", "path"),
    # a filter on path does
    "report_by_city": _report_sql(f"city, {_VIEWS}", _RAW.format("2024-01-02 06:00:00", "2024-01-25 18:00:00")
                                  + " AND path IN ('/dir1/type1', '/dir2/type2', '/dir3/type3')", "city"),
    "report_filtered": _report_sql(f"country_code, {_BOTH}", _RAW.format("2024-01-05 07:30:00", "2024-01-27 13:00:00")
                                   + " AND browser IN ('Chrome', 'Safari', 'Firefox') "
                                     "AND path IN ('/dir0/type0', '/dir1/type1', '/dir4/type4')", "country_code"),
    "report_day_truncated": _report_sql(f"country_code, {_BOTH}", _DAYS.format("2024-01-03 12:00:00", "2024-01-21 06:00:00"), "country_code"),
    "report_total_visitors": _report_sql("count(DISTINCT visitor) AS visitors", _DAYS.format("2024-01-03 12:00:00", "2024-01-20 00:00:00")),
    # one day: 5 minutes; ten days, not more: hours; 26 days: days
    "report_timeseries_5min": _buckets_sql(f"time, {_BOTH}", "fact", "time", "5 minutes", "2024-01-10 00:00:00", "2024-01-11 00:00:00", "time"),
    "report_timeseries_hour": _buckets_sql(f"time, {_BOTH}", "fact", "time", "hour", "2024-01-05 00:00:00", "2024-01-15 00:00:00", "time"),
    "report_timeseries_day": _buckets_sql(f"time, {_BOTH}", "fact", "time", "day", "2024-01-02 12:00:00", "2024-01-28 06:00:00", "time",
                                          "country_code IN ('NAA', 'NAB', 'NAC', 'NAD', 'NAE', 'NAF', 'NAG')"),
} | {  # 30 days, not more: hours; 32 days: days; one day: 5 minutes
    name: _buckets_sql("api_key, site, b AS ts, CAST(sum(visitors) AS BIGINT) AS visitors", "vts", "b", bucket, lo, hi, "api_key, site, b")
    for name, bucket, lo, hi in [
        ("report_visitor_timeseries", "hour", "2024-01-01 00:00:00", "2024-01-31 00:00:00"),
        ("report_visitor_timeseries_day", "day", "2023-12-31 00:00:00", "2024-02-01 00:00:00"),
        ("report_visitor_timeseries_5min", "5 minutes", "2024-01-01 00:00:00", "2024-01-02 00:00:00")]
}


REPORT_CASES = {
    # name: (report, kwargs)
    "report_by_country": ("by_country", {}),
    "report_by_browser": ("by_browser", {"start": "2024-01-04 00:00:00", "end": "2024-01-09 00:00:00"}),
    "report_by_os": ("by_os", {}),
    "report_by_path": ("by_path", {"start": "2024-01-02 06:00:00", "end": "2024-01-25 18:00:00",
                                   "filters": {"os": ["Android", "iOS", "Windows"]}}),
    "report_by_city": ("by_city", {"start": "2024-01-02 06:00:00", "end": "2024-01-25 18:00:00",
                                   "filters": {"path": ["/dir1/type1", "/dir2/type2", "/dir3/type3"]}}),
    "report_filtered": ("by_country", {"start": "2024-01-05 07:30:00", "end": "2024-01-27 13:00:00",
                                       "filters": {"browser": ["Chrome", "Safari", "Firefox"],
                                                   "path": ["/dir0/type0", "/dir1/type1", "/dir4/type4"]}}),
    "report_day_truncated": ("by_country", {"start": "2024-01-03 12:00:00", "end": "2024-01-21 06:00:00"}),
    "report_total_visitors": ("total_visitors", {"start": "2024-01-03 12:00:00", "end": "2024-01-20 00:00:00"}),
}
for _qname, (_rep, _kw) in REPORT_CASES.items():
    def _mk(rep=_rep, kw=_kw):
        def fn(spark, sf_dir):
            fact = _m(spark, sf_dir).section_combined
            return report.REPORTS[rep](fact, KEYS, SITES, **kw)
        return fn
    register(_qname, REPORT_SQL[_qname])(_mk())

TS_CASES = {
    "report_timeseries_5min": ("2024-01-10 00:00:00", "2024-01-11 00:00:00", None),
    "report_timeseries_hour": ("2024-01-05 00:00:00", "2024-01-15 00:00:00", None),
    "report_timeseries_day": ("2024-01-02 12:00:00", "2024-01-28 06:00:00",
                              {"country_code": ["NAA", "NAB", "NAC", "NAD", "NAE", "NAF", "NAG"]}),
}
for _qname, (_lo, _hi, _f) in TS_CASES.items():
    def _mk(lo=_lo, hi=_hi, f=_f):
        def fn(spark, sf_dir):
            return report.timeseries(_m(spark, sf_dir).section_combined, KEYS, SITES, lo, hi, f)
        return fn
    register(_qname, REPORT_SQL[_qname])(_mk())

VTS_CASES = {
    "report_visitor_timeseries": ("2024-01-01 00:00:00", "2024-01-31 00:00:00"),
    "report_visitor_timeseries_day": ("2023-12-31 00:00:00", "2024-02-01 00:00:00"),
    "report_visitor_timeseries_5min": ("2024-01-01 00:00:00", "2024-01-02 00:00:00"),
}
for _qname, (_lo, _hi) in VTS_CASES.items():
    def _mk(lo=_lo, hi=_hi):
        def fn(spark, sf_dir):
            return report.visitor_timeseries(_m(spark, sf_dir).visitor_timeseries, KEYS, SITES, lo, hi)
        return fn
    register(_qname, REPORT_SQL[_qname])(_mk())


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views and visitors per hour over ten days (G2 on the E1 fact)."""
    return SPARK["report_timeseries_hour"](spark, sf_dir)


# ----------------------------------------------------------------- ingest A1, B1-B15

def _ingest(spark, sf_dir):
    from webmetrics.operators import ingest
    from webmetrics.sources import adapter, dims
    src = dims.sources(dims.api_key_latest(adapter.api_keys(spark, sf_dir)))
    return ingest.validate(adapter.requests(spark, sf_dir), src)


def _bodies(spark, sf_dir):
    from webmetrics.sources import adapter
    r = adapter.requests(spark, sf_dir)
    return r.select("request_id", "received_at", F.posexplode("events").alias("pos", "e"))


@register("uuid7_time", O.with_ingest(
    "SELECT request_id, pos, lower(bid) AS id, version, CASE WHEN version = 7 THEN ts END AS ts "
    "FROM rq_body WHERE version IS NOT NULL"))
def uuid7_time(spark, sf_dir):
    """Version and second-truncated time of every parsable body id."""
    from webmetrics.functions.ids import is_uuid, uuid7_ts, uuid_norm, uuid_version
    b = _bodies(spark, sf_dir)
    i = F.coalesce(F.col("e.i"), F.col("e.id"))
    return b.where(is_uuid(i)).select(
        "request_id", "pos", uuid_norm(i).alias("id"), uuid_version(i).alias("version"),
        F.when(uuid_version(i) == 7, uuid7_ts(i)).alias("ts"))


@register("time_window_accept", O.with_ingest(
    "SELECT request_id, pos, ts, received_at, "
    "(ts > received_at - INTERVAL 1 HOUR AND ts < received_at + INTERVAL 5 MINUTE) AS accepted "
    "FROM rq_body WHERE version = 7"))
def time_window_accept(spark, sf_dir):
    """The exclusive (-1 h, +5 min) acceptance window around receive time."""
    from webmetrics import schema as S
    from webmetrics.functions.ids import uuid7_ts, uuid_version
    b = _bodies(spark, sf_dir)
    i = F.coalesce(F.col("e.i"), F.col("e.id"))
    ts = uuid7_ts(i)
    r = F.col("received_at")
    acc = ((ts > r - F.expr(f"INTERVAL {S.MAX_BEFORE_SECONDS} SECONDS"))
           & (ts < r + F.expr(f"INTERVAL {S.MAX_AFTER_SECONDS} SECONDS")))
    return b.where(uuid_version(i) == 7).select("request_id", "pos", ts.alias("ts"), "received_at",
                                                acc.alias("accepted"))


@register("request_summary", O.with_ingest(
    f"SELECT request_id, {O.STATUS_SQL} AS status, reason, "
    "CASE WHEN reason IS NULL THEN n ELSE 0 END AS event_count FROM chk"))
def request_summary(spark, sf_dir):
    """Per request the status class, the first failing reason, events saved."""
    return _ingest(spark, sf_dir).summary


@register("request_atomic", O.with_ingest(
    "SELECT request_id, pos, api_key, site, event_type, id, ts, parent FROM accepted"))
def request_atomic(spark, sf_dir):
    """Events of accepted requests only (all-or-nothing per request)."""
    e = _ingest(spark, sf_dir).events
    return e.select("request_id", "pos", "api_key", "site", "event_type", "id", "ts",
                    F.col("attrs")["parent"].alias("parent"))


@register("request_quarantine", O.with_ingest(
    f"SELECT c.request_id, b.pos, c.reason, {O.STATUS_SQL} AS status FROM chk c "
    "LEFT JOIN rq_body b ON b.request_id = c.request_id WHERE c.reason IS NOT NULL"))
def request_quarantine(spark, sf_dir):
    """Every event of a refused request (empty requests give one row, pos NULL)."""
    q = _ingest(spark, sf_dir).quarantine
    return q.select("request_id", "pos", "reason", "status")


@register("attrs_normalise", O.with_ingest(
    "SELECT id, event_type, parent, user_agent, ipv4, ipv6, location, title, "
    "concat_ws(',', CASE WHEN ipv4 IS NOT NULL THEN 'ipv4' END, CASE WHEN ipv6 IS NOT NULL THEN 'ipv6' END, "
    "CASE WHEN location IS NOT NULL THEN 'location' END, CASE WHEN parent IS NOT NULL THEN 'parent' END, "
    "CASE WHEN title IS NOT NULL THEN 'title' END, CASE WHEN user_agent IS NOT NULL THEN 'user_agent' END) AS attr_keys "
    "FROM accepted"))
def attrs_normalise(spark, sf_dir):
    """Renamed, filtered attribute maps (ip under ipv4 / ipv6)."""
    e = _ingest(spark, sf_dir).events
    a = F.col("attrs")
    return e.select("id", "event_type", a["parent"].alias("parent"), a["user_agent"].alias("user_agent"),
                    a["ipv4"].alias("ipv4"), a["ipv6"].alias("ipv6"), a["location"].alias("location"),
                    a["title"].alias("title"),
                    F.array_join(F.array_sort(F.map_keys(a)), ",").alias("attr_keys"))


@register("known_source_semi", O.with_model(
    "SELECT api_key, site, event_type, count(*) AS events FROM ("
    " SELECT api_key, site, 'Visitor' AS event_type FROM visitor"
    " UNION ALL SELECT api_key, site, 'Session' FROM session_raw"
    " UNION ALL SELECT 'key-' || t, 'site' || t || '.example.com',"
    "   CASE WHEN event_type = 'click' THEN 'Click' ELSE 'Section' END FROM ev"
    "   WHERE t < 3 AND event_type IN ('view', 'purchase', 'click')) GROUP BY 1, 2, 3"))
def known_source_semi(spark, sf_dir):
    """Hub events of allowed sources (broadcast left semi join)."""
    from webmetrics.operators import route
    m = _m(spark, sf_dir)
    return (route.known(m.event, m.sources).groupBy("api_key", "site", "event_type")
            .agg(F.count(F.lit(1)).alias("events")))


@register("api_key_latest", O.with_model(
    "SELECT api_key, site, 'customer-' || substr(api_key, 5) || '-v2' AS customer, 2::BIGINT AS seq FROM keys"))
def api_key_latest(spark, sf_dir):
    """Last version per (api_key, site) wins."""
    from webmetrics.sources import adapter, dims
    return dims.api_key_latest(adapter.api_keys(spark, sf_dir))


# ----------------------------------------------------------------- D6 cidr, D8, D9, K7

def _blocks(spark, sf_dir, mode="range"):
    from webmetrics.plans.facts import geo_blocks
    return geo_blocks(spark, sf_dir, mode)


@register("range_to_cidr", O.with_model(
    f"SELECT {O.ip_text('s')} AS ip_range_start, {O.ip_text('e')} AS ip_range_end, "
    f"{O.ip_text('net')} || '/' || plen AS cidr, net, plen FROM cidr2", O.CIDR_CTES))
def range_to_cidr(spark, sf_dir):
    """Covering block of each range by the reference's xor/log2 rule (Q4 kept)."""
    from webmetrics.functions.net import ipv4_to_long, range_to_cidr as r2c
    from webmetrics.sources import adapter
    r = adapter.ip_ranges(spark, sf_dir)
    c = r2c(ipv4_to_long("ip_range_start"), ipv4_to_long("ip_range_end"))
    return r.select("ip_range_start", "ip_range_end", c["cidr"].alias("cidr"),
                    c["net"].alias("net"), c["plen"].alias("plen"))


@register("iso_left_join", O.with_model(
    f"SELECT {O.ip_text('s')} AS ip_range_start, {O.ip_text('e')} AS ip_range_end, country_code, state, city "
    "FROM blocks"))
def iso_left_join(spark, sf_dir):
    """Alpha-2 -> alpha-3 by broadcast left join; '' for unmatched / blank."""
    from webmetrics.functions.net import long_to_ipv4
    b = _blocks(spark, sf_dir, "range")
    return b.select(long_to_ipv4("start").alias("ip_range_start"), long_to_ipv4("end").alias("ip_range_end"),
                    "country_code", "state", "city")


@register("geo_ip_cidr", O.with_model("""
SELECT DISTINCT r.ipv4, coalesce(g2.country_code, 'unknown') AS country_code,
       coalesce(g2.state, 'unknown') AS state, coalesce(g2.city, 'unknown') AS city
FROM session_raw r LEFT JOIN g2 ON r.ip = g2.ip""", O.CIDR_CTES.strip() + """,
cb AS (SELECT c.net AS cs, c.net + (1::BIGINT << c.bits) - 1 AS ce, c.plen, b.country_code, b.state, b.city
       FROM cidr2 c JOIN blocks b ON c.s = b.s AND c.e = b.e),
g2 AS (SELECT ip, country_code, state, city FROM (
         SELECT ips.ip, cb.*, row_number() OVER (PARTITION BY ips.ip ORDER BY cb.plen DESC) AS rn
         FROM (SELECT DISTINCT ip FROM session_raw) ips JOIN cb ON ips.ip BETWEEN cb.cs AND cb.ce) WHERE rn = 1)"""))
def geo_ip_cidr(spark, sf_dir):
    """D6 (mode='cidr'): longest-prefix match as an equi join on (plen, net)."""
    from webmetrics.operators import enrich, route
    m = _m(spark, sf_dir)
    s = route.sessions(m.event, m.sources)
    g = enrich.geo_ip(s, _blocks(spark, sf_dir, "cidr"), "ipv4", "cidr")
    return g.select("ipv4", "country_code", "state", "city").distinct()


RETENTION_AS_OF = "2024-01-20 00:00:00"


@register("retention_week", O.with_model(
    f"SELECT api_key, site, id, ts FROM section WHERE ts + INTERVAL 7 DAY > TIMESTAMP '{RETENTION_AS_OF}'"))
def retention_week(spark, sf_dir):
    """K7: page views still retained one week after their time, as of a fixed instant."""
    from webmetrics.sources.sinks import retained
    return retained(_m(spark, sf_dir).section, RETENTION_AS_OF).select("api_key", "site", "id", "ts")


# ----------------------------------------------------------------- action log O1-O5

def _act_id(code: str, ts: str, seq: str) -> str:
    return O.uuid7(f"epoch_us({ts}) // 1000", code, f"({seq} % 281474976710656)")


ACTION_SQL = f"""
WITH act AS (
  SELECT 'key-' || (user_id % 4) AS api_key, CAST(user_id AS VARCHAR) AS client, event_id AS seq, ts,
         CASE WHEN event_type = 'view' AND k % 10 = 7 THEN 'registerSession'
              WHEN event_type = 'view' THEN 'registerSection'
              WHEN event_type IN ('purchase', 'click') THEN 'registerClick'
              WHEN event_type = 'signup' THEN 'registerVisitor'
              WHEN k % 3 = 0 THEN 'deregisterVisitor' WHEN k % 3 = 1 THEN 'deregisterSession'
              ELSE 'deregisterSection' END AS action,
         'https://site' || (user_id % 4) || '.example.com/dir' || (k % 6) || '/type' || (k % 5) || '?k=' || k
           || '#s' || (k % 3) AS loc,
         '/dir' || (k % 6) || '/type' || (k % 5) || ' | Demo' AS ttl
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)),
ep AS (
  SELECT *,
    sum(CASE WHEN action IN ('registerVisitor', 'deregisterVisitor') THEN 1 ELSE 0 END) OVER w AS v_ep,
    sum(CASE WHEN action IN ('registerVisitor', 'deregisterVisitor', 'registerSession', 'deregisterSession')
        THEN 1 ELSE 0 END) OVER w AS s_ep,
    sum(CASE WHEN action IN ('registerVisitor', 'deregisterVisitor', 'registerSession', 'deregisterSession',
        'registerSection', 'deregisterSection') THEN 1 ELSE 0 END) OVER w AS x_ep
  FROM act WINDOW w AS (PARTITION BY api_key, client ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
cv AS (SELECT api_key, client, v_ep, min(seq) AS seq FROM ep
       WHERE action IN ('registerVisitor', 'registerSession', 'registerSection', 'registerClick')
       GROUP BY 1, 2, 3),
cs AS (SELECT api_key, client, s_ep, min(seq) AS seq FROM ep
       WHERE action IN ('registerSession', 'registerSection', 'registerClick') GROUP BY 1, 2, 3),
cx AS (SELECT api_key, client, x_ep, min(seq) AS seq FROM ep
       WHERE action IN ('registerSection', 'registerClick') GROUP BY 1, 2, 3),
v AS (SELECT e.*, {_act_id('1', 'e.ts', 'e.seq')} AS id FROM cv JOIN ep e USING (api_key, client, seq)),
s AS (SELECT e.*, {_act_id('2', 'e.ts', 'e.seq')} AS id FROM cs JOIN ep e USING (api_key, client, seq)),
x AS (SELECT e.*, {_act_id('3', 'e.ts', 'e.seq')} AS id FROM cx JOIN ep e USING (api_key, client, seq)),
c AS (SELECT e.*, {_act_id('4', 'e.ts', 'e.seq')} AS id FROM ep e WHERE action = 'registerClick')
SELECT api_key, client, seq, 0 AS sub, 'Visitor' AS event_type, id, ts, NULL AS parent, NULL AS location, NULL AS title FROM v
UNION ALL
SELECT s.api_key, s.client, s.seq, 1, 'Session', s.id, s.ts, v.id, NULL, NULL
FROM s LEFT JOIN v ON s.api_key = v.api_key AND s.client = v.client AND s.v_ep = v.v_ep
UNION ALL
SELECT x.api_key, x.client, x.seq, 2, 'Section', x.id, x.ts, s.id,
       CASE WHEN x.action IN ('registerSection', 'registerClick') THEN x.loc END,
       CASE WHEN x.action IN ('registerSection', 'registerClick') THEN x.ttl END
FROM x LEFT JOIN s ON x.api_key = s.api_key AND x.client = s.client AND x.s_ep = s.s_ep
UNION ALL
SELECT c.api_key, c.client, c.seq, 3, 'Click', c.id, c.ts, x.id, NULL, NULL
FROM c LEFT JOIN x ON c.api_key = x.api_key AND c.client = x.client AND c.x_ep = x.x_ep
"""


@register("action_hierarchy", ACTION_SQL)
def action_hierarchy(spark, sf_dir):
    """O1-O3: client action log -> events with ancestors created on demand."""
    from webmetrics.operators import actions
    from webmetrics.sources import adapter
    return actions.from_actions(adapter.actions(spark, sf_dir))


@register("action_hierarchy_chunked", ACTION_SQL)
def action_hierarchy_chunked(spark, sf_dir):
    """O1-O3 with tiny prefix-sum chunks (a client spread over many groups)."""
    from webmetrics.operators import actions
    from webmetrics.sources import adapter
    return actions.from_actions(adapter.actions(spark, sf_dir), chunk=64)


@register("action_wire", ACTION_SQL.replace("\nSELECT api_key, client, seq, 0 AS sub", ", out AS (\nSELECT api_key, client, seq, 0 AS sub", 1)
          + """)
SELECT api_key, client, seq, sub, CASE event_type WHEN 'Visitor' THEN 1 WHEN 'Session' THEN 2
       WHEN 'Section' THEN 3 ELSE 4 END AS t, id AS i,
       concat_ws(',', CASE WHEN location IS NOT NULL THEN 'l' END, CASE WHEN parent IS NOT NULL THEN 'p' END,
                 CASE WHEN title IS NOT NULL THEN 't' END) AS a_keys
FROM out WHERE seq % 7 <> 0""")
def action_wire(spark, sf_dir):
    """Wire bodies {t, i, a} of the emitted events whose id is a valid v7 reference;
    every seventh action's ids are of version 4, not UUIDs or missing."""
    from webmetrics.functions.ids import with_version
    from webmetrics.operators import actions
    from webmetrics.sources import adapter
    ev = actions.from_actions(adapter.actions(spark, sf_dir))
    bad = F.when(F.col("seq") % 2 == 0, with_version(F.col("id"), "4")).when(F.col("seq") % 3 == 0, F.lit("none"))
    ev = ev.withColumn("id", F.when(F.col("seq") % 7 == 0, bad).otherwise(F.col("id")))
    w = actions.to_wire(ev.where(actions.valid_reference(F.col("id"))))
    return w.select("api_key", "client", "seq", "sub", "t", "i",
                    F.array_join(F.array_sort(F.map_keys("a")), ",").alias("a_keys"))


# ----------------------------------------------------------------- synthetic job N1-N10

def _synth(spark, sf_dir):
    """Synthetic tenant scaled by the driver data: base = distinct users of
    ``events``, as_of = its last event time, tenant = key-0."""
    from webmetrics.operators import synth
    from webmetrics.sources import adapter
    r = adapter.read(spark, sf_dir, "events").agg(
        F.count_distinct("user_id").alias("n"), F.unix_seconds(F.max(F.col("ts").cast("timestamp"))).alias("t")).first()
    as_of = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=r.t)
    return synth.Synth(int(r.n), as_of, SY.API_KEY, SY.SITE)


@register("synth_paths", SY.PATHS)
def synth_paths(spark, sf_dir):
    """The path catalogue, each path with the ``events`` that draw it (event_id modulo
    the number of paths, F15)."""
    from webmetrics.operators import synth
    from webmetrics.sources import adapter
    e = adapter.read(spark, sf_dir, "events").select(F.pmod("event_id", F.lit(synth.N_PATHS)).cast("int").alias("rv"))
    return synth.paths(spark).join(e.groupBy("rv").agg(F.count(F.lit(1)).alias("events")), "rv")


@register("synth_browsers", SY.BROWSERS)
def synth_browsers(spark, sf_dir):
    """Generated agents parsed by the UA rules, each with the users of ``events`` that
    draw it (user_id modulo 100)."""
    from webmetrics.operators import synth
    from webmetrics.sources import adapter, dims
    u = adapter.read(spark, sf_dir, "events").select(F.pmod("user_id", F.lit(100)).cast("int").alias("rv"), "user_id")
    users = u.groupBy("rv").agg(F.count_distinct("user_id").alias("users"))
    return synth.browsers(spark, dims.ua_rules_df(spark)).join(users, "rv")


# ----------------------------------------------------------------- sinks A3-A8: incremental batches

def _appended(spark, sf_dir, table):
    """The hub in two batches that split every visit (children before their parents too),
    the first batch written again at the end; the table as read back."""
    import uuid

    from webmetrics.plans import facts
    from webmetrics.session import checkpoint_dir
    from webmetrics.sources import sinks
    m = _m(spark, sf_dir)
    root = f"{checkpoint_dir(spark).rstrip('/')}/append-{uuid.uuid4().hex}"
    sinks.write_table(m.event, f"{root}/hub", "event", "overwrite")     # shaped from the raw tables once
    m = m.rebuild(sinks.read_table(spark, f"{root}/hub").drop("event_date"))
    first = F.pmod(F.crc32("id"), F.lit(2)) == 0
    for batch, rows in [(0, first), (1, ~first), (0, first)]:
        part = facts.build(m.event.where(rows), m.api_key_df, m.rules_df, m.blocks, m.geo_mode)
        sinks.write_model(part, root, "append", batch)
    return sinks.read_table(spark, f"{root}/{table}", table, ("batch",))


@register("sink_append_section", SQL["route_section"])
def sink_append_section(spark, sf_dir):
    """A5: page views of two appended batches."""
    return _appended(spark, sf_dir, "section_event").select("api_key", "site", "id", "ts", "parent", "path", "query", "fragment", "title")


@register("sink_append_hierarchy", SQL["hierarchy"])
def sink_append_hierarchy(spark, sf_dir):
    """The hierarchy of two appended batches equals one join over everything."""
    return _appended(spark, sf_dir, "hierarchy_event").select("api_key", "site", "visitor", "session", "section", "ts")


@register("sink_append_section_combined", SQL["section_combined"])
def sink_append_section_combined(spark, sf_dir):
    """The fact of two appended batches equals one join over everything."""
    return _appended(spark, sf_dir, "section_combined").select(*rollup.FACT_COLS)


@register("sink_append_visitor_timeseries", SQL["visitor_timeseries_state"])
def sink_append_visitor_timeseries(spark, sf_dir):
    """Partial sums of two appended batches, merged."""
    return rollup.merge_timeseries(_appended(spark, sf_dir, "visitor_timeseries"))


@register("section_combined_merge", SQL["section_combined"])
def section_combined_merge(spark, sf_dir):
    """The fact by a sort-merge join that the caller asks for."""
    m = _m(spark, sf_dir)
    return rollup.section_combined(m.section, m.session, "merge")


def _colocated(spark, sf_dir):
    """The hub in two batches that split every visit (children before their parents too), by joining id."""
    from webmetrics.plans import facts
    from webmetrics.sources import colocated, sinks
    m = _m(spark, sf_dir)
    root = _run_folder(spark, "colocated")
    sinks.write_table(m.event, f"{root}/hub", "event", "overwrite")     # shaped from the raw tables once
    m = m.rebuild(sinks.read_table(spark, f"{root}/hub").drop("event_date"))
    store = colocated.open_store(spark, f"{root}/store", int(spark.conf.get("spark.sql.shuffle.partitions")))
    first = F.pmod(F.crc32("id"), F.lit(2)) == 0
    for batch, rows in enumerate((first, ~first)):
        colocated.write_typed(facts.build(m.event.where(rows), m.api_key_df, m.rules_df, m.blocks, m.geo_mode), store, batch)
    return store


@register("colocated_section_combined", SQL["section_combined"])
def colocated_section_combined(spark, sf_dir):
    """E1 over tables bucketed on its key, written in batches: no exchange."""
    from webmetrics.sources import colocated
    return colocated.section_combined(_colocated(spark, sf_dir))


@register("colocated_hierarchy", SQL["hierarchy"])
def colocated_hierarchy(spark, sf_dir):
    """E3, E8 over tables bucketed on each join's key, written in batches: no exchange."""
    from webmetrics.sources import colocated
    return colocated.hierarchy(_colocated(spark, sf_dir))


@register("sorted_insert_order", O.with_model(
    "SELECT site, count(*) AS page_views, 0 AS out_of_order FROM section GROUP BY site"))
def sorted_insert_order(spark, sf_dir):
    """Page views as stored, by site, and how many lie behind a larger key in their file (none:
    so row groups hold narrow ranges of the key, which scans skip by their statistics)."""
    from pyspark.sql import Window

    from webmetrics.sources import sinks
    path = f"{_run_folder(spark, 'sorted')}/section_event"
    sinks.write_table(_m(spark, sf_dir).section, path, "section_event", "overwrite")
    t = sinks.read_table(spark, path, "section_event").select(
        "site", F.struct(*sinks.LAYOUTS["section_event"].sort).alias("k"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("i"))
    behind = F.lag("k").over(Window.partitionBy("file").orderBy("i")) > F.col("k")
    return t.withColumn("behind", behind).groupBy("site").agg(
        F.count(F.lit(1)).alias("page_views"), F.sum(F.when(F.col("behind"), 1).otherwise(0)).cast("int").alias("out_of_order"))


@register("sink_compacted_section_combined", SQL["section_combined"])
def sink_compacted_section_combined(spark, sf_dir):
    """Two batches, compacted; a third one finds its parents and children in the
    compacted tables; compacted again, and what the first round left is deleted."""
    from webmetrics.plans import facts
    from webmetrics.sources import sinks, snapshots
    m = _m(spark, sf_dir)
    root = _run_folder(spark, "compacted")
    sinks.write_table(m.event, f"{root}/hub", "event", "overwrite")
    m = m.rebuild(sinks.read_table(spark, f"{root}/hub").drop("event_date"))
    part = F.pmod(F.crc32("id"), F.lit(3))
    for batch in range(3):
        sinks.write_model(facts.build(m.event.where(part == batch), m.api_key_df, m.rules_df, m.blocks, m.geo_mode), root, "append", batch)
        if batch:
            sinks.compact(spark, root)
    path = f"{root}/section_combined"
    snapshots.vacuum(spark, path, grace=0)
    return sinks.read_table(spark, path, "section_combined", ("batch",)).select(*rollup.FACT_COLS)


_EXPIRED_AS_OF = dt.datetime(2024, 1, 20)


@register("sink_expired_section", O.with_model(
    "SELECT api_key, site, id, ts, parent, path FROM section WHERE ts >= TIMESTAMP '2024-01-13 00:00:00'"))
def sink_expired_section(spark, sf_dir):
    """K7: two batches of page views, compacted; days expired by manifest are out of every read,
    then their files go."""
    from webmetrics.sources import sinks, snapshots
    path = f"{_run_folder(spark, 'expired')}/section_event"
    section = _m(spark, sf_dir).section
    for batch in (0, 1):
        sinks.write_table(section.where(F.pmod(F.crc32("id"), F.lit(2)) == batch), f"{path}/batch={batch}", "section_event", "overwrite")
    sinks.compact(spark, path.rsplit("/", 1)[0], ["section_event"], upto=0)
    snapshots.expire(spark, path, _EXPIRED_AS_OF)
    snapshots.vacuum(spark, path, grace=0)
    return sinks.read_table(spark, path, "section_event", ("batch",)).select("api_key", "site", "id", "ts", "parent", "path")


def _run_folder(spark, what):
    import uuid

    from webmetrics.session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


@register("dims_from_files", SQL["iso_left_join"])
def dims_from_files(spark, sf_dir):
    """The country table and the address ranges written as CSV (with a header;
    gzipped without one), read back and joined (D9)."""
    from webmetrics import schema as S
    from webmetrics.functions.net import long_to_ipv4
    from webmetrics.sources import adapter, dims
    run = _run_folder(spark, "dims")
    adapter.iso_country(spark, sf_dir).select(*S.ISO_COUNTRY.names).write.option("header", True).csv(f"{run}/iso")
    adapter.ip_ranges(spark, sf_dir).select(*S.IP_RANGE.names).write.option("compression", "gzip").csv(f"{run}/ranges")
    b = enrich.blocks_from_ranges(dims.read_ip_range_csv(spark, f"{run}/ranges"), dims.read_iso_csv(spark, f"{run}/iso"))
    return b.select(long_to_ipv4("start").alias("ip_range_start"), long_to_ipv4("end").alias("ip_range_end"),
                    "country_code", "state", "city")


@register("sink_compacted_timeseries", SQL["visitor_timeseries_state"])
def sink_compacted_timeseries(spark, sf_dir):
    """partial sums of two halves of the visitors, appended to one table and compacted:
    one row per key."""
    from webmetrics.sources import sinks
    run = _run_folder(spark, "compact")
    visitor = _m(spark, sf_dir).visitor
    for k in (0, 1):
        half = visitor.where(F.pmod(F.crc32("id"), F.lit(2)) == k)
        sinks.write_table(rollup.visitor_timeseries(half), f"{run}/parts", "visitor_timeseries", "append")
    sinks.compact_timeseries(spark, f"{run}/parts", f"{run}/whole")
    return sinks.read_table(spark, f"{run}/whole", "visitor_timeseries").drop("event_date")


@register("sink_backfill_section", SQL["route_section"])
def sink_backfill_section(spark, sf_dir):
    """A table that holds other rows is replaced by staged ones."""
    from webmetrics.sources import sinks
    run = _run_folder(spark, "backfill")
    section = _m(spark, sf_dir).section
    sinks.write_table(section.where("path like '%1'"), f"{run}/section_event", "section_event", "append")
    sinks.backfill({"section_event": section}, run)
    return sinks.read_table(spark, f"{run}/section_event", "section_event").select(
        "api_key", "site", "id", "ts", "parent", "path", "query", "fragment", "title")


@register("synth_visitors", SY.VISITORS)
def synth_visitors(spark, sf_dir):
    """20 * base visitors (uniform year + three spikes)."""
    v = _synth(spark, sf_dir).visitors(spark)
    return v.select("api_key", "site", "event_type", "id", "ts", F.col("attrs")["channel"].alias("channel"))


@register("synth_sessions", SY.SESSIONS)
def synth_sessions(spark, sf_dir):
    """10 sessions per visitor with catalogue agents."""
    from webmetrics.operators import synth
    from webmetrics.sources import dims
    s = _synth(spark, sf_dir)
    return s.routed_sessions(spark, synth.browsers(spark, dims.ua_rules_df(spark)))


@register("synth_sections", SY.SECTIONS)
def synth_sections(spark, sf_dir):
    """10 page views per session."""
    x = _synth(spark, sf_dir).sections(spark)
    return x.select("api_key", "site", "event_type", "id", "ts", *[F.col("attrs")[a].alias(a) for a in ("parent", "location", "title")])


@register("synth_section_combined", SY.COMBINED)
def synth_section_combined(spark, sf_dir):
    """The synthetic hub routed, enriched and joined by the real plan (E1), a part of the
    staged hub after another: the disk holds the hub and one part's shuffles, whose rows then
    replace the part."""
    from webmetrics.operators import synth
    from webmetrics.plans import facts
    from webmetrics.plans.strategy import session_conf
    from webmetrics.sources import adapter, dims
    s = _synth(spark, sf_dir)
    rules, keys, blocks = dims.ua_rules_df(spark), adapter.api_keys(spark, sf_dir), facts.geo_blocks(spark, sf_dir)
    hub = synth.stage_hub(s, spark, rules)
    path = _run_folder(spark, "synth-combined")
    for part in range(hub.parts):
        fact = facts.build(hub.rows(part), keys, rules, blocks).section_combined
        with session_conf(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
            fact.write.option("compression", "zstd").parquet(f"{path}/part={part}")
        hub.drop(part)
    return spark.read.schema(fact.schema).parquet(*[f"{path}/part={k}" for k in range(hub.parts)])


# ----------------------------------------------------------------- UA rules as a table

@register("ua_rule_table", """
    WITH a AS (SELECT DISTINCT user_id AS u, event_id % 20 AS f, event_id % 7 AS v FROM events),
    seen AS (SELECT 'Mozilla/5.0 (Linux; Android 14; Unit-' || u || ') AppleWebKit/537.36 Reader' || f || '/' || v || '.2 Mobile'
             AS user_agent, u, f, v FROM a)
    SELECT user_agent, CASE WHEN c_custkey IS NULL THEN '' ELSE 'Nation ' || c_nationkey END AS device_brand,
           CASE WHEN c_custkey IS NULL THEN 'Other' ELSE 'Unit ' || u END AS device_model, 'Android' AS os, '14..0' AS os_version,
           CASE WHEN f < 15 THEN 'Reader ' || f ELSE 'Other' END AS browser, CASE WHEN f < 15 THEN v || '.2' ELSE '0.0' END AS browser_version
    FROM seen LEFT JOIN customer ON c_custkey = u""")
def ua_rule_table(spark, sf_dir):
    """A12, D2-D5 with thousands of rules: a rule per row of ``customer`` and 15 families of
    browsers, written as JSON lines and read back, over agents that ``events`` draw."""
    import uuid

    from webmetrics.session import checkpoint_dir
    from webmetrics.sources import adapter, dims
    path = f"{checkpoint_dir(spark).rstrip('/')}/ua-rules-{uuid.uuid4().hex}"
    units = adapter.read(spark, sf_dir, "customer").selectExpr(
        "'device' AS kind", "10 AS priority", "concat('Unit-(', c_custkey, ')[);]') AS regex",
        "map('brand', concat('Nation ', c_nationkey), 'device', 'Unit $1') AS repl")
    readers = spark.range(15).selectExpr(
        "'browser' AS kind", "1 AS priority", r"concat('Reader', id, r'/(\d+)\.(\d+)') AS regex",
        "map('family', concat('Reader ', id), 'v1', '$1', 'v2', '$2') AS repl")
    units.unionByName(readers).unionByName(dims.ua_rules_df(spark)).write.json(path)
    agents = adapter.read(spark, sf_dir, "events").selectExpr(
        "concat('Mozilla/5.0 (Linux; Android 14; Unit-', user_id, ') AppleWebKit/537.36 Reader', event_id % 20, '/', event_id % 7, "
        "'.2 Mobile') AS user_agent").distinct()
    return enrich.user_agents(agents, dims.read_ua_rules(spark, path))


# ----------------------------------------------------------------- reports from daily rollups

def _stored_daily(spark, sf_dir, name):
    """A daily rollup as stored by two batches of the fact, which share all days."""
    import uuid

    from webmetrics.session import checkpoint_dir
    from webmetrics.sources import sinks
    root = f"{checkpoint_dir(spark).rstrip('/')}/daily-{uuid.uuid4().hex}"
    fact = _m(spark, sf_dir).section_combined
    half = F.pmod(F.crc32("visitor"), F.lit(2))
    for batch in (0, 1):
        sinks.write_table(fact.where(half == batch), f"{root}/section_combined/batch={batch}", "section_combined", "overwrite")
        sinks.write_daily(spark, root, batch, (name,))
    return sinks.read_table(spark, f"{root}/{name}", name, ("batch",))


@register("report_by_os_rollup", SQL["report_by_os"])
def report_by_os_rollup(spark, sf_dir):
    """G5 answered from the stored F9 daily rollup of two batches = G5 on the fact."""
    d = _stored_daily(spark, sf_dir, "daily_by_os")
    return report.from_daily(d, "by_os", "os", KEYS, SITES)


_ROLLUP_RANGE = ("2024-01-02 06:00:00", "2024-01-25 18:00:00")


@register("report_by_path_rollup", _report_sql(f"path, {_VIEWS}", _DAYS.format(*_ROLLUP_RANGE), "path"))
def report_by_path_rollup(spark, sf_dir):
    """G6 over > 10 days with non-midnight bounds (day-truncated) from the stored F10 rollup."""
    d = _stored_daily(spark, sf_dir, "daily_by_path")
    return report.from_daily(d, "by_path", "path", KEYS, SITES, *_ROLLUP_RANGE)


# ----------------------------------------------------------------- streaming runs K1, K4

def _stream_source(spark, sf_dir, in_order=False):
    """Request envelopes written as JSON files into the shared checkpoint folder
    (one run folder per call), the input of the file-source streams. ``in_order``:
    written in four time ranges one after the other, so files are as old as their rows."""
    import uuid

    from webmetrics.session import checkpoint_dir
    from webmetrics.sources import adapter
    run = f"{checkpoint_dir(spark).rstrip('/')}/stream-run-{uuid.uuid4().hex}"
    requests = adapter.requests(spark, sf_dir)
    if not in_order:
        requests.repartition(8, "request_id").write.json(f"{run}/requests")
        return run
    requests.write.parquet(f"{run}/shaped")     # from the raw tables once
    requests = spark.read.schema(requests.schema).parquet(f"{run}/shaped")
    at = F.unix_seconds("received_at")
    lo, hi = requests.agg(F.min(at), F.max(at)).first()
    part = F.least(F.floor((at - F.lit(lo)) * 4 / F.lit(max(1, (hi or 0) - (lo or 0)))), F.lit(3))
    for k in range(4):
        requests.where(F.coalesce(part, F.lit(0)) == k).repartition(_files(spark), "request_id").write.mode("append").json(f"{run}/requests")
    return run


def _files(spark):
    """Files of a time range, which one trigger reads."""
    return max(2, spark.sparkContext.defaultParallelism)


def _sources(spark, sf_dir):
    from webmetrics.sources import adapter, dims
    return dims.sources(dims.api_key_latest(adapter.api_keys(spark, sf_dir)))


@register("stream_visitor_counts", O.with_ingest(
    "SELECT api_key, site, epoch_ms(epoch_ms(ts) // 300000 * 300000) AS ts, count(*) AS visitors "
    "FROM accepted WHERE event_type = 'Visitor' GROUP BY 1, 2, 3"))
def stream_visitor_counts(spark, sf_dir):
    """K4/K5: watermarked 5-minute visitor counts over the validated request stream
    (file source read in order of receipt, update mode), the newest row of each window."""
    from webmetrics import schema as S
    from webmetrics.streaming import fanout
    run = _stream_source(spark, sf_dir, in_order=True)
    stream = spark.readStream.schema(S.REQUEST).option("maxFilesPerTrigger", _files(spark)).json(f"{run}/requests")
    out = f"{run}/visitor_counts"
    fanout.start_visitor_counts(fanout.validated_events(stream, _sources(spark, sf_dir)), out, f"{run}/ckpt-vc").awaitTermination()
    return fanout.read_visitor_counts(spark, out)


@register("stream_fanout_sections", O.with_ingest(
    "SELECT api_key, site, id, ts, parent, "
    "coalesce(regexp_extract(location, '^[a-z]+://[^/?#]*([^?#]*)', 1), '') AS path FROM accepted "
    "WHERE event_type = 'Section' AND parent > ''"))
def stream_fanout_sections(spark, sf_dir):
    """K1: the checkpointed foreachBatch fan-out; page-view table as stored."""
    from webmetrics import schema as S
    from webmetrics.sources import adapter
    run = _stream_source(spark, sf_dir)
    stream = spark.readStream.schema(S.REQUEST).option("maxFilesPerTrigger", 4).json(f"{run}/requests")
    tables = _fan_out(spark, sf_dir, stream, run, lambda: adapter.api_keys(spark, sf_dir))
    return tables(spark, f"{run}/tables", "section_event").select("api_key", "site", "id", "ts", "parent", "path")


@register("stream_hierarchy", SQL["hierarchy"])
def stream_hierarchy(spark, sf_dir):
    """K3 over three streams: page views, sessions and visitors in four files each, in order of
    time; links within two hours meet in state, the others in the stored tables."""
    from webmetrics.sources import sinks
    from webmetrics.streaming import fanout
    m, run = _m(spark, sf_dir), _run_folder(spark, "hierarchy")
    tables = {"section_event": m.section, "session_event": m.session.select("api_key", "site", "id", "ts", "parent"), "visitor_event": m.visitor}
    for name, df in tables.items():
        sinks.write_table(df.drop("attrs"), f"{run}/stored/{name}/batch=0", name, "overwrite")
    rows = {n: sinks.read_table(spark, f"{run}/stored/{n}", n, ("batch",)) for n in tables}
    at = F.unix_seconds("ts")
    lo, hi = rows["section_event"].agg(F.min(at), F.max(at)).first()
    part = F.greatest(F.lit(0), F.least(F.floor((at - F.lit(lo or 0)) * 4 / F.lit(max(1, (hi or 0) - (lo or 0)))), F.lit(3)))
    streams = {}
    for name, df in rows.items():
        cols = ["api_key", "site", "id", "ts", *(["parent"] if "parent" in df.columns else [])]
        for k in range(4):
            df.where(part == k).select(*cols).repartition(1).write.mode("append").parquet(f"{run}/in/{name}")
        streams[name] = spark.readStream.schema(df.select(*cols).schema).option("maxFilesPerTrigger", 1).parquet(f"{run}/in/{name}")
    links = fanout.hierarchy_links(streams["section_event"], streams["session_event"], streams["visitor_event"])
    fanout.start_hierarchy(links, f"{run}/links", f"{run}/ckpt", f"{run}/stored").awaitTermination()
    return fanout.read_hierarchy(spark, f"{run}/links", f"{run}/stored")


def _fan_out(spark, sf_dir, stream, run, keys):
    from webmetrics.plans.facts import geo_blocks
    from webmetrics.sources import dims
    from webmetrics.streaming import fanout
    blocks = fanout.Refreshing(lambda: geo_blocks(spark, sf_dir), fanout.GEO_TTL)
    fanout.start_fan_out(stream, f"{run}/tables", f"{run}/ckpt-fan", fanout.Refreshing(keys, fanout.KEY_TTL), dims.ua_rules_df(spark), blocks).awaitTermination()
    return fanout.read_tables


@register("stream_quarantine", SQL["request_quarantine"])
def stream_quarantine(spark, sf_dir):
    """A source of messages (a JSON text each) through the fan-out; refused events as
    stored by the batches."""
    from webmetrics.operators import ingest
    from webmetrics.sources import adapter
    run = _stream_source(spark, sf_dir)
    messages = spark.readStream.option("maxFilesPerTrigger", 4).text(f"{run}/requests")
    tables = _fan_out(spark, sf_dir, ingest.parse_request_json(messages), run, lambda: adapter.api_keys(spark, sf_dir))
    return tables(spark, f"{run}/tables", "request_quarantine").select("request_id", "pos", "reason", "status")


#: Changes of keys: key-0 is out for a week, key-1 comes later, key-2 is replaced at one time.
KEY_CHANGES = [("key-0", 1, "2023-01-01", True), ("key-0", 2, "2024-01-10", False), ("key-0", 3, "2024-01-17", True),
               ("key-1", 1, "2024-01-12", True), ("key-2", 1, "2023-06-01", False), ("key-2", 2, "2023-06-01", True)]


@register("stream_keys_as_of", O.with_ingest(
    "SELECT a.api_key, a.site, a.event_type, a.id, a.ts FROM accepted a JOIN chk c ON c.request_id = a.request_id "
    "WHERE CASE a.api_key WHEN 'key-0' THEN c.received_at < TIMESTAMP '2024-01-10' OR c.received_at >= TIMESTAMP '2024-01-17' "
    "WHEN 'key-1' THEN c.received_at >= TIMESTAMP '2024-01-12' ELSE true END"))
def stream_keys_as_of(spark, sf_dir):
    """K6/K8: the validated stream with keys as of each request's receipt."""
    from webmetrics import schema as S
    from webmetrics.operators import ingest
    from webmetrics.sources import dims
    run = _stream_source(spark, sf_dir)
    rows = [(k, SITES[int(k[-1])], n, dt.datetime.fromisoformat(t), on) for k, n, t, on in KEY_CHANGES]
    spark.createDataFrame(rows, "api_key string, site string, seq long, valid_from timestamp, active boolean").write.parquet(f"{run}/keys")

    def store(batch, bid):
        known = dims.key_versions(spark.read.parquet(f"{run}/keys"))        # as it is now, for every batch
        ingest.hub(ingest.validate(batch, known)).drop("attrs").write.mode("overwrite").parquet(f"{run}/events/batch={bid}")

    stream = spark.readStream.schema(S.REQUEST).option("maxFilesPerTrigger", 4).json(f"{run}/requests")
    stream.writeStream.option("checkpointLocation", f"{run}/ckpt").foreachBatch(store).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{run}/events").select("api_key", "site", "event_type", "id", "ts")


@register("report_by_country_rollup", O.with_model(
    f"SELECT country_code, {_VIEWS}, true AS visitors_close FROM fact WHERE {_TENANT} AND {_DAYS.format('2024-01-03 12:00:00', '2024-01-21 06:00:00')} GROUP BY country_code"))
def report_by_country_rollup(spark, sf_dir):
    """G1 by rewrite (`use_rollup`): a range of whole days from the stored rollup's sketches; visitors
    within three standard errors (1.04 / sqrt(2^12)) of the exact count, or one of them."""
    daily = _stored_daily(spark, sf_dir, "daily_by_country")
    fact = _m(spark, sf_dir).section_combined
    span = ("2024-01-03 12:00:00", "2024-01-21 06:00:00")
    got = report.answer("by_country", fact, KEYS, SITES, *span, distinct="hll", rollups={"country_code": daily})
    exact = report.answer("by_country", fact, KEYS, SITES, *span).select("country_code", F.col("visitors").alias("exact"))
    off = F.abs(F.col("visitors") - F.col("exact")) <= F.greatest(F.lit(1.0), 3 * 1.04 / 2 ** 6 * F.col("exact"))
    return got.join(exact, "country_code").select("country_code", "page_views", off.alias("visitors_close"))


@register("visitors_hll", O.with_model(
    "SELECT country_code, count(*) AS page_views, count(DISTINCT visitor) AS visitors, true AS hll_close, "
    "true AS approx_close FROM fact GROUP BY 1"))
def visitors_hll(spark, sf_dir):
    """exact distinct visitors per country, and whether the mergeable HLL sketch
    (relative error 1.04 / sqrt(2^12)) and ``approx_count_distinct`` (0.01) lie within
    three standard errors, or one visitor, of them."""
    fact = _m(spark, sf_dir).section_combined
    out = report.by_country(fact, KEYS, SITES)
    for mode, error in [("hll", 1.04 / 2 ** 6), ("approx", 0.01)]:
        got = report.by_country(fact, KEYS, SITES, distinct=mode).select("country_code", F.col("visitors").alias(mode))
        off = F.abs(F.col(mode) - F.col("visitors")) <= F.greatest(F.lit(1.0), F.lit(3 * error) * F.col("visitors"))
        out = out.join(got, "country_code").withColumn(f"{mode}_close", off).drop(mode)
    return out
