"""Dimension sources."""

import gzip

from webmetrics.operators import enrich
from webmetrics.sources import dims


def test_api_key_latest_and_sources(spark):
    df = spark.createDataFrame([("k", "s", "old", 1), ("k", "s", "new", 2), (" k2 ", " s2 ", "c", 1),
                                ("", "s3", "c", 1)], "api_key string, site string, customer string, seq long")
    latest = {(r.api_key, r.site): r.customer for r in dims.api_key_latest(df).collect()}
    assert latest[("k", "s")] == "new"
    assert sorted(tuple(r) for r in dims.sources(df).collect()) == [("k", "s"), ("k2", "s2")]


def test_csv_readers_and_geo(spark, tmp_path):
    iso = tmp_path / "iso.csv"
    iso.write_text("name,alpha-2,alpha-3,country-code,iso_3166-2,region,sub-region,intermediate-region,"
                   "region-code,sub-region-code,intermediate-region-code\n"
                   "Testland,TL,TLD,999,ISO 3166-2:TL,Europe,,,150,,\n")
    rng = tmp_path / "ranges.csv.gz"
    with gzip.open(rng, "wt") as f:
        f.write("1.2.3.0,1.2.3.255,TL,State,,City,,1.5,2.5,\n")
        f.write("1.2.0.0,1.2.255.255,XX,,,,,0,0,\n")
    iso_df = dims.read_iso_csv(spark, str(iso))
    assert iso_df.first().cca3 == "TLD"
    r = dims.read_ip_range_csv(spark, str(rng))
    assert r.count() == 2
    blocks = enrich.blocks_from_ranges(r, iso_df)
    df = spark.createDataFrame([("1.2.3.4",), ("1.2.9.9",)], "ipv4 string")
    got = {x.ipv4: (x.country_code, x.state, x.city) for x in enrich.geo_ip(df, blocks, "ipv4").collect()}
    assert got == {"1.2.3.4": ("TLD", "State", "City"), "1.2.9.9": ("", "", "")}


def test_keys_as_of_the_receipt(spark, tmp_path):
    """K8: a key that is added while the stream runs is accepted from then on, one taken out is not."""
    import datetime as dt

    from webmetrics import schema as S
    from webmetrics.operators import ingest
    from webmetrics.sources import dims

    t0 = dt.datetime(2024, 1, 1, 12)
    kinds = "api_key string, site string, seq long, valid_from timestamp, active boolean"
    changes = [("a", "h.com", 1, t0, True), ("a", "h.com", 2, t0 + dt.timedelta(hours=2), False), ("b", " ", 1, t0, True), ("b", "h.com", 1, None, True),
               ("c", "h.com", 1, t0, False), (" c ", "h.com", 2, t0, True)]
    spark.createDataFrame(changes, kinds).write.parquet(str(tmp_path / "keys"))
    got = sorted((r.api_key, r.valid_from, r.valid_to) for r in dims.key_versions(spark.read.parquet(str(tmp_path / "keys"))).collect())
    assert got == [("a", t0, t0 + dt.timedelta(hours=2)), ("c", t0, None)]

    def request(n, key, hours):
        at = t0 + dt.timedelta(hours=hours)
        ms = int(at.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
        return (n, at, "https://h.com/x", key, "ua", "10.0.0.1", [(1, f"{ms:012x}"[:8] + "-" + f"{ms:012x}"[8:] + f"-7000-8000-{n:012x}", {}, None, None, None)])

    def store(batch, bid):
        known = dims.key_versions(spark.read.schema(kinds).parquet(str(tmp_path / "keys")))
        ingest.validate(batch, known).summary.write.mode("overwrite").parquet(str(tmp_path / f"out/batch={bid}"))

    def run(rows):
        spark.createDataFrame(rows, S.REQUEST).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        q = spark.readStream.schema(S.REQUEST).json(str(tmp_path / "in")).writeStream.foreachBatch(store)
        q.option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start().awaitTermination(300)

    run([request(1, "a", 0), request(2, "a", 1.9), request(3, "a", 2), request(4, "b", 1), request(5, "c", 0), request(6, "c", -1)])
    spark.createDataFrame([("b", "h.com", 2, t0 + dt.timedelta(hours=3), True)], kinds).write.mode("append").parquet(str(tmp_path / "keys"))
    run([request(7, "b", 2.9), request(8, "b", 3), request(9, "a", 4)])
    got = {r.request_id: (r.status, r.reason) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert {n for n, (s, _) in got.items() if s == 201} == {1, 2, 5, 8}
    assert {r for n, (_, r) in got.items() if n not in (1, 2, 5, 8)} == {"UnknownSource"} and len(got) == 9
