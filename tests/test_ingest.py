"""Literal cases of FIXTURES 2.1 / 2.2 (acceptance of events and requests)."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from webmetrics import schema as S
from webmetrics.operators import ingest

R = dt.datetime(2024, 3, 1, 12, 0, 0)
SRC = [("abc", "test.com"), ("key-1", "site1.example.com")]


def v7(t: dt.datetime, tail: int = 1) -> str:
    ms = int((t - dt.datetime(1970, 1, 1)).total_seconds() * 1000)
    h = f"{ms:012x}"
    return f"{h[:8]}-{h[8:12]}-7000-8000-{tail:012x}"


V4 = "4e2abe52-5e86-4023-9f8b-34eba8d2cc59"
PARENT = v7(R, 99)


def req(spark, events, api_key="abc", origin="http://test.com/test/dir", ua="Mozilla/5.0",
        ip="127.0.0.1", rid=1):
    bodies = [{"t": e[0], "i": e[1], "a": e[2] if len(e) > 2 else None} for e in events]
    row = {"request_id": rid, "received_at": R, "origin": origin, "api_key": api_key,
           "user_agent": ua, "ip": ip,
           "events": [dict(b, event_type=None, id=None, attrs=None) for b in bodies]}
    return spark.createDataFrame([row], S.REQUEST)


def run(spark, df):
    src = spark.createDataFrame(SRC, "api_key string, site string")
    return ingest.validate(df, src)


def reason(spark, df):
    r = run(spark, df).summary.first()
    return r.reason, r.status


@pytest.mark.parametrize("delta,ok", [
    (dt.timedelta(0), True), (dt.timedelta(minutes=-30), True), (dt.timedelta(minutes=2), True),
    (dt.timedelta(minutes=-70), False), (dt.timedelta(minutes=20), False),
    (dt.timedelta(seconds=-3601), False), (dt.timedelta(seconds=301), False),
    (dt.timedelta(seconds=-3600), False), (dt.timedelta(seconds=300), False),
])
def test_time_window(spark, delta, ok):
    got = reason(spark, req(spark, [(1, v7(R + delta))]))
    assert got == ((None, 201) if ok else ("TimestampOutOfRange", 400))


def test_uuid_version(spark):
    assert reason(spark, req(spark, [(1, V4)])) == ("UuidVersion", 400)


def test_blank_key_and_site(spark):
    assert reason(spark, req(spark, [(1, v7(R))], api_key=" ")) == ("ApiKey", 400)


def test_trimmed_key_accepted(spark):
    res = run(spark, req(spark, [(1, v7(R))], api_key=" abc "))
    assert res.summary.first().status == 201
    assert res.events.first().api_key == "abc"


@pytest.mark.parametrize("attrs", [None, {}, {"p": "x"}])
@pytest.mark.parametrize("t", [2, 3, 4])
def test_parent_required(spark, t, attrs):
    assert reason(spark, req(spark, [(t, v7(R), attrs)])) == ("InvalidRequestBody", 400)


def test_parent_checked_before_version(spark):
    assert reason(spark, req(spark, [(3, V4, {"p": "x"})])) == ("InvalidRequestBody", 400)


def test_section_without_location_title(spark):
    res = run(spark, req(spark, [(3, v7(R), {"p": PARENT})]))
    e = res.events.first()
    assert e.event_type == "Section" and dict(e.attrs) == {"parent": PARENT}


def test_unknown_attr_dropped_and_renamed(spark):
    res = run(spark, req(spark, [(3, v7(R), {"p": PARENT, "l": "https://h/a", "t": "T", "zz": "q"})]))
    assert dict(res.events.first().attrs) == {"parent": PARENT, "location": "https://h/a", "title": "T"}


@pytest.mark.parametrize("t", [0, 5])
def test_bad_type(spark, t):
    assert reason(spark, req(spark, [(t, v7(R))])) == ("InvalidRequestBody", 400)


def test_type_numbers(spark):
    evs = [(1, v7(R, 1)), (2, v7(R, 2), {"p": PARENT}), (3, v7(R, 3), {"p": PARENT}), (4, v7(R, 4), {"p": PARENT})]
    rows = run(spark, req(spark, evs)).events.orderBy("pos").collect()
    assert [r.event_type for r in rows] == ["Visitor", "Session", "Section", "Click"]


@pytest.mark.parametrize("ip,key", [("127.0.0.1", "ipv4"), ("::1", "ipv6")])
def test_session_ip_key(spark, ip, key):
    e = run(spark, req(spark, [(2, v7(R), {"p": PARENT})], ip=ip)).events.first()
    assert dict(e.attrs) == {"parent": PARENT, "user_agent": "Mozilla/5.0", key: ip}


def test_site_from_origin(spark):
    assert run(spark, req(spark, [(1, v7(R))])).events.first().site == "test.com"


@pytest.mark.parametrize("kw,expect", [
    ({"origin": None}, ("InvalidRequestHeaders", 400)),
    ({"api_key": None}, ("ApiKey", 400)),
    ({"ua": None}, ("InvalidRequestHeaders", 400)),
    ({"api_key": "wrong"}, ("UnknownSource", 500)),
])
def test_header_faults(spark, kw, expect):
    assert reason(spark, req(spark, [(1, v7(R))], **kw)) == expect


def test_empty_array(spark):
    res = run(spark, req(spark, []))
    s = res.summary.first()
    assert (s.reason, s.status, s.event_count) == ("InvalidRequest", 500, 0)
    assert res.quarantine.count() == 1


def test_one_visitor_saved(spark):
    s = run(spark, req(spark, [(1, v7(R))])).summary.first()
    assert (s.status, s.event_count) == (201, 1)


def test_all_or_nothing(spark):
    res = run(spark, req(spark, [(1, v7(R, 1)), (1, V4), (1, v7(R, 3))]))
    assert res.events.count() == 0
    assert res.quarantine.count() == 3
    assert res.summary.first().reason == "UuidVersion"


def test_first_failing_event_wins(spark):
    evs = [(1, v7(R, 1)), (1, v7(R - dt.timedelta(hours=2), 2)), (1, V4)]
    assert reason(spark, req(spark, evs)) == ("TimestampOutOfRange", 400)


def test_body_error_beats_event_error(spark):
    evs = [(1, V4), (5, v7(R))]
    assert reason(spark, req(spark, evs)) == ("InvalidRequestBody", 400)


def test_long_key_aliases(spark):
    row = {"request_id": 7, "received_at": R, "origin": "http://test.com", "api_key": "abc",
           "user_agent": "UA", "ip": "1.2.3.4",
           "events": [{"t": None, "i": None, "a": None, "event_type": 3, "id": v7(R),
                       "attrs": {"p": PARENT}}]}
    res = run(spark, spark.createDataFrame([row], S.REQUEST))
    assert res.events.first().event_type == "Section"


def test_read_requests_json(spark, tmp_path):
    ev = [{"t": 1, "i": v7(R)}, {"event_type": 3, "id": v7(R, 2), "attrs": {"p": PARENT, "l": "https://test.com/x"}}]
    line = {"request_id": 3, "received_at": R.isoformat(), "origin": "http://test.com",
            "api_key": "abc", "user_agent": "UA", "ip": "1.2.3.4", "events": ev}
    p = tmp_path / "req.json"
    p.write_text(json.dumps(line) + "\n")
    df = ingest.read_requests(spark, str(p))
    res = run(spark, df)
    assert res.summary.first().status == 201
    assert sorted(r.event_type for r in res.events.collect()) == ["Section", "Visitor"]
    # message-source form
    msg = spark.createDataFrame([(json.dumps(line),)], "value string")
    assert run(spark, ingest.parse_request_json(msg)).summary.first().event_count == 2
    assert F is not None


def test_uuid_text_forms(spark):
    from webmetrics.functions import ids
    u = "f47ac10b-58cc-4372-a567-0e02b2c3d479"
    rows = [(u,), ("{" + u + "}",), ("urn:uuid:" + u,), (u.replace("-", "").upper(),), ("{" + u,), (u + "}",), ("urn:" + u,), (None,)]
    got = spark.createDataFrame(rows, "u string").select(ids.uuid_norm("u"), ids.uuid_version("u")).collect()
    assert [tuple(r) for r in got] == [(u, 4)] * 4 + [(None, None)] * 4
