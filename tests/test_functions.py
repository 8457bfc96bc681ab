import datetime as dt

from pyspark.sql import functions as F

from webmetrics.functions.ids import is_uuid, uuid7, uuid7_millis, uuid7_ts, uuid_norm, uuid_version
from webmetrics.functions.net import ipv4_to_long, long_to_ipv4, range_to_cidr
from webmetrics.functions.timefn import bucket5, ceil_to, granularity, start_of_day, start_of_hour
from webmetrics.functions.url import url_host, url_part


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_uuid7_roundtrip(spark):
    ms = 1704067207179  # 2024-01-01 00:00:07.179
    r = one(spark, uuid7(F.lit(ms), F.lit(3), F.lit(255)).alias("u"))
    assert r.u == "018cc252-100b-7003-8000-0000000000ff"
    r = one(spark, uuid7_millis(F.lit(r.u)).alias("ms"), uuid7_ts(F.lit(r.u)).alias("ts"),
            uuid_version(F.lit(r.u)).alias("v"))
    assert r.ms == ms
    assert r.ts == dt.datetime(2024, 1, 1, 0, 0, 7)  # sub-second part dropped
    assert r.v == 7


def test_uuid_checks(spark):
    r = one(spark, is_uuid(F.lit("4e2abe52-5e86-4023-9f8b-34eba8d2cc59")).alias("a"),
            uuid_version(F.lit("4e2abe52-5e86-4023-9f8b-34eba8d2cc59")).alias("v"),
            is_uuid(F.lit("x")).alias("b"), is_uuid(F.lit(None).cast("string")).alias("c"),
            is_uuid(F.lit("4E2ABE525E8640239F8B34EBA8D2CC59")).alias("d"),
            uuid_norm(F.lit("4E2ABE525E8640239F8B34EBA8D2CC59")).alias("n"))
    assert (r.a, r.v, r.b, r.c, r.d) == (True, 4, False, False, True)
    assert r.n == "4e2abe52-5e86-4023-9f8b-34eba8d2cc59"


def test_ipv4(spark):
    r = one(spark, ipv4_to_long(F.lit("10.1.2.3")).alias("a"), ipv4_to_long(F.lit("::1")).alias("b"),
            long_to_ipv4(F.lit(167838211)).alias("c"), ipv4_to_long(F.lit("256.1.1.1")).alias("d"))
    assert (r.a, r.b, r.c, r.d) == (167838211, None, "10.1.2.3", None)


def _cidr(spark, s, e):
    c = range_to_cidr(ipv4_to_long(F.lit(s)), ipv4_to_long(F.lit(e)))
    return one(spark, c["cidr"].alias("cidr"), c["plen"].alias("plen")).cidr


def test_range_to_cidr_cases(spark):
    assert _cidr(spark, "10.0.0.0", "10.0.0.255") == "10.0.0.0/24"
    assert _cidr(spark, "10.0.0.5", "10.0.0.5") == "10.0.0.5/32"
    # quirk Q4: an exact power-of-two xor is one bit short
    assert _cidr(spark, "10.0.0.0", "10.0.0.1") == "10.0.0.0/32"
    assert _cidr(spark, "10.1.0.0", "10.1.255.255") == "10.1.0.0/16"


def test_buckets(spark):
    ts = F.lit(dt.datetime(2024, 1, 1, 0, 7, 31))
    r = one(spark, bucket5(ts).alias("b"), start_of_hour(ts).alias("h"), start_of_day(ts).alias("d"))
    assert r.b == dt.datetime(2024, 1, 1, 0, 5)
    assert r.h == dt.datetime(2024, 1, 1, 0, 0)
    assert r.d == dt.datetime(2024, 1, 1)


def test_granularity():
    lo = dt.datetime(2024, 1, 1)
    assert granularity(lo, lo + dt.timedelta(days=10)) == "hour"
    assert granularity(lo, lo + dt.timedelta(days=10, seconds=1)) == "day"
    assert granularity(lo, lo + dt.timedelta(days=1)) == "5min"
    assert granularity(lo, lo + dt.timedelta(days=1, seconds=1)) == "hour"
    assert granularity(None, None) == "5min"
    assert granularity(lo, lo + dt.timedelta(days=30), 30) == "hour"
    assert granularity(lo, lo + dt.timedelta(days=31), 30) == "day"
    assert ceil_to(dt.datetime(2024, 1, 1, 12), 86400) == dt.datetime(2024, 1, 2)
    assert ceil_to(dt.datetime(2024, 1, 1), 86400) == dt.datetime(2024, 1, 1)


def test_url_parts(spark):
    u = F.lit("https://h/a/b?x=1&y=2#z")
    r = one(spark, url_part(u, "PATH").alias("p"), url_part(u, "QUERY").alias("q"),
            url_part(u, "REF").alias("f"), url_part(F.lit("https://h"), "PATH").alias("p2"))
    assert (r.p, r.q, r.f, r.p2) == ("/a/b", "x=1&y=2", "z", "")


def test_url_host(spark):
    r = one(spark, url_host(F.lit("http://test.com/test/dir")).alias("a"),
            url_host(F.lit(None).cast("string")).alias("b"), url_host(F.lit("https://")).alias("c"),
            url_host(F.lit("test.com")).alias("d"))
    assert (r.a, r.b, r.c, r.d) == ("test.com", None, None, "test.com")


def test_uuid_norm_of_canonical_and_odd_texts(spark):
    """Text in canonical form stays; a line feed at the end, which $ passes, goes."""
    u = "018cc252-100b-7003-8000-0000000000ff"
    forms = [u, u + "\n", u.upper(), "{" + u + "}", "urn:uuid:" + u, u.replace("-", "") + "\n", u + "\n\n", " " + u, u[:-1], "", None]
    rows = spark.createDataFrame(list(enumerate(forms)), "k int, c string").select("k", uuid_norm("c").alias("n")).orderBy("k").collect()
    assert [r.n for r in rows] == [u] * 6 + [None] * 5
