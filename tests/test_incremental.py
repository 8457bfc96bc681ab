"""Facts by batch (K2/K3): equal to one join over everything, reads bounded by the days named."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from webmetrics import schema as S
from webmetrics.operators import rollup
from webmetrics.sources import incremental, sinks
from webmetrics.streaming import fanout

DAY = 86_400_000
T0 = 1_704_067_200_000      # 2024-01-01


def uid(ms, n, version=7):
    h = f"{ms:012x}"
    return f"{h[:8]}-{h[8:]}-{version}000-8000-{n:012x}"


def at(ms):
    return dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=ms // 1000 * 1000)


def files_read(df):
    """Rows and the files that the scans of the executed plan have read."""
    rows = df.collect()

    def scans(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return scans(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return scans(node.plan())
        own = node.metrics().get("numFiles")
        n = own.get().value() if own.isDefined() else 0
        return n + sum(scans(node.children().apply(i)) for i in range(node.children().size()))

    return rows, scans(df._jdf.queryExecution().executedPlan())


def model(seed):
    """Visitors, sessions and page views: late, repeated, far, unknown and garbage parents."""
    r = random.Random(seed)
    vis = [uid(T0 + r.randrange(40 * DAY), i) for i in range(12)]
    ses = [(uid(T0 + r.randrange(40 * DAY), 100 + i), r.choice(vis) if i % 7 else uid(T0, 9000 + i)) for i in range(30)]
    ses += [(uid(T0 - 90 * DAY, 200), vis[0]), ses[3], ses[3], ses[4]]
    parents = [i for i, _ in ses] + [uid(T0, 7777), uid(2 ** 47, 1, 4), uid(3, 5)]
    sec = [(uid(T0 + r.randrange(40 * DAY), 1000 + i), r.choice(parents)) for i in range(150)]
    sec += sec[:3]
    ms = lambda i: int(i[:8] + i[9:13], 16)
    key = lambda i: ("k", f"s{int(i[-2:], 16) % 2}")
    v = [(*("k", "s0"), i, at(ms(i))) for i in vis] + [(*("k", "s1"), i, at(ms(i))) for i in vis]
    s = [(*("k", t), i, at(ms(i)), p, "os", "br", "cc", "city") for i, p in ses for t in ("s0", "s1")]
    x = [(*key(p), i, at(ms(i)), p, f"/{i[-3:]}") for i, p in sec]
    return v, s, x


COLS = {"visitor_event": "api_key string, site string, id string, ts timestamp",
        "session_event": "api_key string, site string, id string, ts timestamp, parent string, os string, browser string, country_code string, city string",
        "section_event": "api_key string, site string, id string, ts timestamp, parent string, path string"}


def rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_in_any_order_of_arrival_equal_one_join(spark, tmp_path, seed):
    r, root, whole = random.Random(seed), str(tmp_path / "t"), {}
    parts = {0: {}, 1: {}, 2: {}}
    for name, data in zip(COLS, model(seed), strict=True):
        whole[name] = spark.createDataFrame(data, COLS[name]).cache()
        deal = [r.randrange(3) for _ in data]
        for b in parts:
            parts[b][name] = [x for x, k in zip(data, deal, strict=True) if k == b]
    for b in (0, 1, 2, 2):      # the last batch once more
        for name in COLS:
            df = spark.createDataFrame(parts[b][name], COLS[name]).coalesce(1).withColumn("event_date", F.to_date("ts"))
            df.write.partitionBy("site", "event_date").mode("overwrite").parquet(f"{root}/{name}/batch={b}")
        sinks.write_facts(spark, root, b)
    fact = sinks.read_table(spark, f"{root}/section_combined", "section_combined", ("batch",))
    want = rows(rollup.section_combined(whole["section_event"], whole["session_event"]), rollup.FACT_COLS)
    assert rows(fact, rollup.FACT_COLS) == want and len(want) > 100
    cols = S.HIERARCHY_EVENT.names
    chain = sinks.read_table(spark, f"{root}/hierarchy_event", "hierarchy_event", ("batch",))
    want = rows(rollup.hierarchy(*[whole[n] for n in ("section_event", "session_event", "visitor_event")]), cols)
    assert rows(chain, cols) == want and len(want) > 50
    # garbage ids make no folders of their own
    folders = {int(f) for p in (0, 1) for f in incremental.subfolders(spark, f"{root}/section_link/pending={p}", "folder")}
    assert len([f for f in folders if f < 0]) <= 3 and max(folders) < T0 // DAY + 60


def history(spark, root, days):
    """A session and page views (one waiting) on each of the days before the last, by batch."""
    d = spark.range(days).withColumn("ms", F.lit(T0) + F.col("id") * DAY)
    from webmetrics.functions.ids import uuid7
    d = d.select(F.lit("k").alias("api_key"), F.lit("s").alias("site"), uuid7(F.col("ms"), F.lit(2), F.col("id")).alias("id"),
                 F.timestamp_millis(F.col("ms")).alias("ts"), F.col("id").alias("batch"), F.floor(F.col("ms") / DAY).alias("folder"))
    ses = d.withColumn("event_date", F.to_date("ts")).withColumn("parent", F.lit(uid(T0, 1))).drop("folder")
    for c in ("os", "browser", "country_code", "city"):
        ses = ses.withColumn(c, F.lit(c))
    ses.write.partitionBy("batch", "site", "event_date").parquet(f"{root}/session_event")
    for pending in (0, 1):
        kids = d.select("api_key", "site", F.concat("id", F.lit(f"-{pending}")).alias("section"),
                        "id" if not pending else F.concat(F.substring("id", 1, 30), F.lit("aaaaaa")), "ts", F.lit("/p").alias("path"), "folder", "batch")
        kids.toDF("api_key", "site", "section", "parent", "ts", "path", "folder", "batch").withColumn("pending", F.lit(pending)).write.mode("append").partitionBy(
            "pending", "folder", "batch").parquet(f"{root}/section_link")


def test_files_read_do_not_grow_with_the_history(spark, tmp_path):
    found = []
    for days in (4, 24):
        root = str(tmp_path / str(days))
        history(spark, root, days)
        last = T0 + (days - 1) * DAY
        late = uid(last, 0xaaaaaa).replace("-7000-", "-7002-")      # the session that the last day's waiting page view names
        ses = spark.createDataFrame([("k", "s", late, at(last), uid(T0, 1), "os", "br", "cc", "city")], COLS["session_event"])
        sec = spark.createDataFrame([("k", "s", uid(last + 60_000, 5), at(last + 60_000), uid(last, days - 1).replace("-7000-", "-7002-"), "/new")], COLS["section_event"])
        rows, n = files_read(sinks._added_pairs(spark, root, days, sec, ses))
        found.append((sorted(r["path"] for r in rows), n))
    assert found[0] == found[1] and found[0][0] == ["/new", "/p"] and found[0][1] <= 12, found


def test_stages_of_a_batch_do_not_have_a_task_per_shuffle_partition(spark, tmp_path):
    """Few rows in few tasks, however many shuffle partitions there are; nothing staged is left."""
    root, before = str(tmp_path / "t"), spark.conf.get("spark.sql.shuffle.partitions")
    for name, data in zip(COLS, model(3), strict=True):
        df = spark.createDataFrame(data, COLS[name]).coalesce(1).withColumn("event_date", F.to_date("ts")).repartition(1)
        df.write.partitionBy("site").parquet(f"{root}/{name}/batch=0")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.sparkContext.setJobGroup("batch", "facts of a batch")
    try:
        sinks.write_facts(spark, root, 0)
        t = spark.sparkContext.statusTracker()
        stages = {i for j in t.getJobIdsForGroup("batch") for i in t.getJobInfo(j).stageIds}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tasks = [x.numTasks for x in map(t.getStageInfo, stages) if x]
    assert tasks and max(tasks) < 60, sorted(tasks)
    assert not [x.name for x in (tmp_path / "t").iterdir() if x.name.startswith("staged-")]


def test_only_earlier_batches_are_asked_for(spark, tmp_path):
    """The days of a batch itself and of later ones, and their children, are not looked up."""
    path = str(tmp_path / "session_event")
    days = spark.range(3).select(F.col("id").alias("batch"), F.lit("s").alias("site"), F.date_add(F.lit(at(T0)).cast("date"), F.col("id").cast("int")).alias("event_date"), F.lit(1).alias("x"))
    days.write.partitionBy("batch", "site", "event_date").parquet(path)
    first = T0 // DAY
    assert sinks.stored_days(spark, path) == {first, first + 1, first + 2}
    assert [sinks.stored_days(spark, path, b) for b in (0, 1, 2)] == [set(), {first}, {first, first + 1}]
    links = days.where("batch > 0").select("batch", "x", F.lit(first).alias("folder"), F.lit(1).alias("pending"))
    links.write.partitionBy("pending", "folder", "batch").parquet(str(tmp_path / "link"))
    schema = links.select("x").schema
    assert incremental.read_links(spark, str(tmp_path / "link"), schema, 1, [first], 1) is None
    assert incremental.read_links(spark, str(tmp_path / "link"), schema, 1, [first], 2).count() == 1


def test_days_that_are_over_go(spark, tmp_path):
    root = str(tmp_path / "t")
    history(spark, root, 5)
    path = f"{root}/section_link"
    assert incremental.expire_links(spark, path, T0 + DAY) == []
    assert len(incremental.expire_links(spark, path, T0 + 3 * DAY + 65 * 60_000)) == 6
    assert {int(f) for f in incremental.subfolders(spark, f"{path}/pending=1", "folder")} == {T0 // DAY + 3, T0 // DAY + 4}


def test_links_beyond_the_bound_are_closed_from_the_stored_tables(spark, tmp_path):
    """A visitor of last month, a session of yesterday, one that comes after its page view, and none."""
    hour = 3_600_000
    v_old, v_new = uid(T0 - 30 * DAY, 1), uid(T0, 2)
    s_far, s_near, s_late, s_none = uid(T0 - 26 * hour, 11), uid(T0, 12), uid(T0 + hour, 13), uid(T0, 99)
    vis = [("k", "s", i, at(int(i[:8] + i[9:13], 16))) for i in (v_old, v_new)]
    ses = [("k", "s", i, at(int(i[:8] + i[9:13], 16)), p) for i, p in ((s_far, v_new), (s_near, v_old), (s_late, v_new))]
    sec = [("k", "s", uid(T0 + 30 * 60_000, 100 + k), at(T0 + 30 * 60_000), p) for k, p in enumerate((s_far, s_near, s_late, s_none))]
    kinds = {n: ", ".join(c.split(", ")[:4 if n == "visitor_event" else 5]) for n, c in COLS.items()}
    streams = {}
    for name, data in zip(COLS, (vis, ses, sec), strict=True):
        df = spark.createDataFrame(data, kinds[name]).coalesce(1)
        df.withColumn("event_date", F.to_date("ts")).write.partitionBy("site", "event_date").parquet(str(tmp_path / f"stored/{name}/batch=0"))
        df.write.parquet(str(tmp_path / f"in/{name}"))
        streams[name] = spark.readStream.schema(df.schema).parquet(str(tmp_path / f"in/{name}"))
    links = fanout.hierarchy_links(streams["section_event"], streams["session_event"], streams["visitor_event"])
    out, stored = str(tmp_path / "out"), str(tmp_path / "stored")
    fanout.start_hierarchy(links, out, str(tmp_path / "ckpt"), stored).awaitTermination(300)
    got = {(r["section"][-3:], r["session"], r["visitor"]) for r in fanout.read_hierarchy(spark, out, stored).collect()}
    assert got == {(uid(0, 100)[-3:], s_far, v_new), (uid(0, 101)[-3:], s_near, v_old), (uid(0, 102)[-3:], s_late, v_new)}
    # a visitor that is stored later closes the open link then
    assert spark.read.parquet(f"{out}/open").count() <= 1
