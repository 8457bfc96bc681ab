"""Manifests: compaction and expiry under readers, conflicts, deletion of what no one reads."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from webmetrics import schema as S
from webmetrics.sources import sinks, snapshots

T0 = dt.datetime(2024, 1, 1, 12)


def batch(spark, path, b, n=6):
    df = spark.createDataFrame([("k", f"s{i % 2}", f"id{b}-{i}", T0 + dt.timedelta(days=i % 3), f"p{i}", "/x") for i in range(n)],
                               "api_key string, site string, id string, ts timestamp, parent string, path string")
    df.coalesce(1).withColumn("event_date", F.to_date("ts")).write.partitionBy("site", "event_date").mode("overwrite").parquet(f"{path}/batch={b}")


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def read(spark, path):
    return sinks.read_table(spark, path, "section_event", ("batch",))


def test_compaction_keeps_every_row_and_old_readers(spark, tmp_path):
    root, path = str(tmp_path), str(tmp_path / "section_event")
    for b in range(3):
        batch(spark, path, b)
    before, want = read(spark, path), ids(read(spark, path))
    sinks.compact(spark, root, ["section_event"], upto=1)
    m = snapshots.manifest(spark, path)
    assert (m.version, m.upto) == (1, 1) and ids(read(spark, path)) == want == ids(before) and len(want) == 18
    assert read(spark, path).where("batch = 0").count() == 0 and read(spark, path).where("batch = 1").count() == 12
    batch(spark, path, 1, 50)                   # a compacted batch is final
    assert ids(read(spark, path)) == want
    batch(spark, path, 3)
    sinks.compact(spark, root)
    assert len(ids(read(spark, path))) == 24 and snapshots.manifest(spark, path).upto == 3
    assert sinks.compact(spark, root)["section_event"].version == 2      # nothing to do
    assert snapshots.vacuum(spark, path, grace=3600) == []
    gone = snapshots.vacuum(spark, path, grace=0)
    assert len([g for g in gone if "/batch=" in g]) == 4 and len([g for g in gone if "_gen" in g]) == 1
    assert len(ids(read(spark, path))) == 24 and snapshots.batches(spark, path) == []
    assert set(read(spark, path).columns) == {*S.SECTION_EVENT.names, "batch", "event_date"}


def test_readers_during_compactions_see_whole_tables(spark, tmp_path):
    root, path = str(tmp_path), str(tmp_path / "section_event")
    batch(spark, path, 0)
    batch(spark, path, 1)
    seen, stop, errors = [], threading.Event(), []

    def loop():
        try:
            while not stop.is_set():
                seen.append(read(spark, path).count())
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    t = threading.Thread(target=loop)
    t.start()
    try:
        for b in (2, 3):
            sinks.compact(spark, root, ["section_event"])
            batch(spark, path, b)
        sinks.compact(spark, root, ["section_event"])
    finally:
        stop.set()
        t.join(120)
    assert not errors and len(seen) >= 2
    assert set(seen) <= {12, 18, 24} | set(range(12, 25)) and seen == sorted(seen) and read(spark, path).count() == 24


def test_only_one_of_two_writers_commits(spark, tmp_path):
    path = str(tmp_path / "section_event")
    batch(spark, path, 0)
    m = snapshots.manifest(spark, path)
    snapshots.commit(spark, path, m, first_day="2024-01-01")
    with pytest.raises(FileExistsError):
        snapshots.commit(spark, path, m, first_day="2024-01-02")
    assert snapshots.manifest(spark, path).first_day == "2024-01-01"

    def slow(df, at):       # another writer is first
        sinks.write_table(df, at, "section_event", "overwrite")
        snapshots.expire(spark, path, dt.datetime(2024, 1, 9))

    with pytest.raises(FileExistsError):
        snapshots.compact(spark, path, S.SECTION_EVENT, slow)
    assert snapshots.manifest(spark, path).base is None and snapshots._names(spark, f"{path}/_gen") == []
    assert sorted(n for n in snapshots._names(spark, f"{path}/_manifest") if n.startswith(".") and not n.endswith(".crc")) == []


def test_expired_days_are_out_of_reads_before_their_files_go(spark, tmp_path):
    root, path = str(tmp_path), str(tmp_path / "section_event")
    for b in range(2):
        batch(spark, path, b)
    sinks.compact(spark, root, ["section_event"], upto=0)
    old = read(spark, path)
    snapshots.expire(spark, path, dt.datetime(2024, 1, 9, 5))
    assert read(spark, path).count() == 8 and old.count() == 12
    assert snapshots.expire(spark, path, dt.datetime(2024, 1, 8)).version == 2      # never backwards
    assert any("event_date=2024-01-01" in g for g in snapshots.vacuum(spark, path, grace=0))
    assert read(spark, path).count() == 8
    assert sinks.stored_days(spark, path) == {19724, 19725}


def test_partial_sums_and_sketches_merge(spark, tmp_path):
    root = str(tmp_path)
    rows = [("k", "s", T0, 2), ("k", "s", T0 + dt.timedelta(minutes=5), 1)]
    fact = [("k", "s", T0, "/a", "os", "br", "cc", "city", f"v{i}") for i in range(5)]
    for b in (0, 1):
        sinks.write_table(spark.createDataFrame(rows, S.VISITOR_TIMESERIES), f"{root}/visitor_timeseries/batch={b}", "visitor_timeseries", "overwrite")
        sinks.write_table(spark.createDataFrame(fact, S.SECTION_COMBINED), f"{root}/section_combined/batch={b}", "section_combined", "overwrite")
        sinks.write_daily(spark, root, b, ("daily_by_os",))
    assert set(sinks.compact(spark, root)) == {"visitor_timeseries", "section_combined", "daily_by_os"}
    ts = sinks.read_table(spark, f"{root}/visitor_timeseries", "visitor_timeseries", ("batch",))
    assert sorted((r["ts"], r["visitors"]) for r in ts.collect()) == [(T0, 4), (T0 + dt.timedelta(minutes=5), 2)]
    d = sinks.read_table(spark, f"{root}/daily_by_os", "daily_by_os", ("batch",)).select("page_views", F.hll_sketch_estimate("visitors_sketch").alias("v")).collect()
    assert [tuple(r) for r in d] == [(10, 5)]
