"""Streaming = batch (K1-K4), sinks write -> read (A3-A8), retention (K7)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from webmetrics import schema as S
from webmetrics.operators import enrich, ingest, rollup
from webmetrics.plans import facts
from webmetrics.sources import adapter, dims, sinks
from webmetrics.streaming import fanout

from .conftest import SF_SMALL

SF_REQ = "/root/testdata/sf0.01"  # dense enough that many requests are accepted


def rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.fixture(scope="module")
def request_dir(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("requests")
    (adapter.requests(spark, SF_REQ).repartition(4, "request_id")
     .write.mode("overwrite").json(str(d)))
    return str(d)


@pytest.fixture(scope="module")
def dims_(spark):
    keys = fanout.Refreshing(lambda: adapter.api_keys(spark, SF_REQ), fanout.KEY_TTL)
    blocks = fanout.Refreshing(lambda: facts.geo_blocks(spark, SF_REQ), fanout.GEO_TTL)
    return keys, dims.ua_rules_df(spark), blocks


def batch_model(spark, request_dir, dims_):
    keys, rules, blocks = dims_
    src = dims.sources(dims.api_key_latest(keys.get()))
    hub = ingest.hub(ingest.validate(ingest.read_requests(spark, request_dir), src))
    return facts.build(hub, keys.get(), rules, blocks.get())


@pytest.mark.parametrize("files_per_trigger", [None, 1])
def test_stream_equals_batch(spark, request_dir, dims_, tmp_path, files_per_trigger):
    keys, rules, blocks = dims_
    r = spark.readStream.schema(S.REQUEST)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    q = fanout.start_fan_out(r.json(request_dir), str(tmp_path / "out"), str(tmp_path / "ckpt"),
                             keys, rules, blocks)
    q.awaitTermination(300)
    m = batch_model(spark, request_dir, dims_)
    out = str(tmp_path / "out")
    fc = list(rollup.FACT_COLS)
    assert rows(fanout.read_tables(spark, out, "visitor_event"), ["id", "ts"]) == rows(m.visitor, ["id", "ts"])
    assert rows(fanout.read_tables(spark, out, "session_event"), ["id", "os", "city"]) == \
        rows(m.session, ["id", "os", "city"])
    got = rows(fanout.read_tables(spark, out, "section_combined"), fc)
    want = rows(m.section_combined, fc)
    assert got == want and len(got) > 0     # also where a session comes after its page views
    hc = ["visitor", "session", "section", "ts"]
    assert rows(fanout.read_tables(spark, out, "hierarchy_event"), hc) == rows(m.hierarchy, hc)
    vts = rollup.merge_timeseries(fanout.read_tables(spark, out, "visitor_timeseries"))
    assert rows(vts, ["api_key", "site", "ts", "visitors"]) == \
        rows(m.visitor_timeseries, ["api_key", "site", "ts", "visitors"])
    n = fanout.read_tables(spark, out, "request_summary").count()
    assert n == spark.read.json(request_dir).count()


def test_visitor_counts_stream(spark, request_dir, dims_):
    keys, rules, blocks = dims_
    src = dims.sources(dims.api_key_latest(keys.get()))
    ev = fanout.validated_events(spark.readStream.schema(S.REQUEST).json(request_dir), src)
    q = (fanout.visitor_counts(ev).writeStream.outputMode("complete").format("memory")
         .queryName("vc_test").trigger(availableNow=True).start())
    q.awaitTermination(300)
    m = batch_model(spark, request_dir, dims_)
    cols = ["api_key", "site", "ts", "visitors"]
    assert rows(spark.table("vc_test"), cols) == rows(m.visitor_timeseries, cols)


def test_stream_stream_join_keeps_late_session(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1, 10, 0)
    ses_dir, sec_dir = tmp_path / "ses", tmp_path / "sec"
    ses_schema = "api_key string, site string, id string, ts timestamp, parent string, os string, " \
                 "browser string, country_code string, city string"
    sec_schema = "api_key string, site string, id string, ts timestamp, parent string, path string"
    spark.createDataFrame([("k", "s", "x1", t0 + dt.timedelta(minutes=3), "s1", "/a")],
                          sec_schema).write.json(str(sec_dir))
    spark.createDataFrame([("k", "s", "s1", t0, "v1", "Linux", "Firefox", "NAA", "C")],
                          ses_schema).write.json(str(ses_dir))
    j = fanout.section_session_join(spark.readStream.schema(sec_schema).json(str(sec_dir)),
                                    spark.readStream.schema(ses_schema).json(str(ses_dir)))
    q = j.writeStream.format("memory").queryName("ssj_test").trigger(availableNow=True).start()
    q.awaitTermination(300)
    got = spark.table("ssj_test").collect()
    assert [(r.path, r.visitor, r.ts) for r in got] == [("/a", "v1", dt.datetime(2024, 1, 1, 10, 0))]


def test_sinks_roundtrip_and_compaction(spark, tmp_path):
    m = facts.driver_model(spark, SF_SMALL)
    paths = sinks.write_model(m, str(tmp_path / "t"), mode="overwrite")
    fact = spark.read.parquet(paths["section_combined"]).drop("event_date")
    fc = list(rollup.FACT_COLS)
    assert rows(fact, fc) == rows(m.section_combined, fc)
    # appending the same visitors again doubles the partial sums; compaction keeps sums
    sinks.write_table(m.visitor_timeseries, paths["visitor_timeseries"], "visitor_timeseries", "append")
    out = str(tmp_path / "vts_compact")
    sinks.compact_timeseries(spark, paths["visitor_timeseries"], out)
    a = rollup.merge_timeseries(spark.read.parquet(paths["visitor_timeseries"]).drop("event_date"))
    b = spark.read.parquet(out).drop("event_date")
    cols = ["api_key", "site", "ts", "visitors"]
    assert rows(a, cols) == rows(b, cols)
    assert b.groupBy("api_key", "site", "ts").count().where("count > 1").count() == 0
    # dynamic overwrite: re-running a batch is idempotent
    sinks.write_table(m.visitor, paths["visitor_event"], "visitor_event", "dynamic")
    assert spark.read.parquet(paths["visitor_event"]).count() == m.visitor.count()


def test_retention(spark, tmp_path):
    m = facts.driver_model(spark, SF_SMALL)
    p = str(tmp_path / "sec")
    sinks.write_table(m.section, p, "section_event", "overwrite")
    as_of = "2024-01-20 00:00:00"
    kept = sinks.retained(spark.read.parquet(p), as_of)
    assert kept.where(F.col("ts") <= F.lit(dt.datetime(2024, 1, 13))).count() == 0
    n_kept = kept.count()
    dropped = sinks.expire_partitions(spark, p, as_of)
    assert dropped
    left = spark.read.parquet(p)
    assert left.where(F.col("event_date") <= F.lit(dt.date(2024, 1, 12))).count() == 0
    assert sinks.retained(left, as_of).count() == n_kept
    # the same below batch folders
    q = str(tmp_path / "batches")
    sinks.write_table(m.section, f"{q}/batch=3", "section_event", "overwrite")
    assert len(sinks.expire_partitions(spark, q, as_of)) == len(dropped)
    assert sinks.retained(spark.read.parquet(q), as_of).count() == n_kept
    assert enrich is not None


def test_bucketed_join_has_no_shuffle(spark, tmp_path):
    m = facts.driver_model(spark, SF_SMALL)
    sinks.write_bucketed(m.session, "session_event", "t_ses_b", 8, str(tmp_path / "ses"))
    sinks.write_bucketed(m.section, "section_event", "t_sec_b", 8, str(tmp_path / "sec"))
    j = rollup.section_combined(spark.table("t_sec_b"), spark.table("t_ses_b"))
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
    fc = list(rollup.FACT_COLS)
    assert rows(j, fc) == rows(m.section_combined, fc)


def test_parent_far_beyond_any_calendar_does_not_stop_the_stream(spark, tmp_path, dims_):
    """A random (version 4) parent id reads as a day after the year 10000."""
    keys, rules, blocks = dims_
    hub_schema = "api_key string, site string, event_type string, id string, ts timestamp, attrs map<string,string>"
    from webmetrics.functions.ids import uuid7, uuid7_ts
    sec_id = spark.range(1).select(uuid7(F.lit(1704067200000), F.lit(3), F.lit(9)).alias("u")).first()[0]
    row = spark.createDataFrame([("key-0", "site0.example.com", "Section", sec_id, None,
                                  {"parent": "f47ac10b-58cc-4372-a567-0e02b2c3d479", "location": "https://site0.example.com/x"})], hub_schema)
    m = facts.build(row.withColumn("ts", uuid7_ts("id")), keys.get(), rules, blocks.get())
    for batch in (0, 1):
        sinks.write_model(m, str(tmp_path / "t"), "append", batch)
    assert spark.read.parquet(str(tmp_path / "t/section_event")).count() == 2
    assert spark.read.schema(S.SECTION_COMBINED).parquet(str(tmp_path / "t/section_combined")).count() == 0


def test_state_has_no_more_partitions_than_cores(spark, tmp_path):
    """Each partition of state writes files in every batch, however few rows there are."""
    import os
    spark.range(50).selectExpr("'k' AS api_key", "'s' AS site", "'Visitor' AS event_type", "cast(id AS string) AS id",
                               "timestamp_seconds(id * 60) AS ts").write.parquet(str(tmp_path / "in"))
    events = spark.readStream.schema("api_key string, site string, event_type string, id string, ts timestamp").parquet(str(tmp_path / "in"))
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        fanout.start_visitor_counts(events, str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "32"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    parts = [x for x in os.listdir(tmp_path / "ckpt" / "state" / "0") if x.isdigit()]
    assert len(parts) == spark.sparkContext.defaultParallelism
    assert sorted(r.visitors for r in fanout.read_visitor_counts(spark, str(tmp_path / "out")).collect()) == [5] * 10


def test_requests_of_an_ordered_stream_are_shaped_once(spark, tmp_path, monkeypatch):
    from webmetrics.plans import catalog
    from webmetrics.sources import adapter
    made = spark.sparkContext.accumulator(0)

    def shaped(rows):
        for frame in rows:
            made.add(len(frame))
            yield frame

    rows = spark.range(40).selectExpr("id AS request_id", "timestamp_seconds(id * 3600) AS received_at").mapInPandas(
        shaped, "request_id long, received_at timestamp")
    monkeypatch.setattr(adapter, "requests", lambda spark, sf_dir: rows)
    run = catalog._stream_source(spark, str(tmp_path), in_order=True)
    got = spark.read.schema("request_id long, received_at timestamp").json(f"{run}/requests")
    assert made.value == 40 and sorted(r.request_id for r in got.collect()) == list(range(40))
