"""Synthetic job (N1-N10) and action log."""

import datetime as dt

from pyspark.sql import functions as F

from webmetrics.operators import actions, rollup, synth
from webmetrics.sources import dims

AS_OF = dt.datetime(2024, 2, 1)


def test_catalogues(spark):
    p = synth.paths(spark)
    assert p.count() == 216 and p.select("path1", "path2", "resource").distinct().count() == 216
    b = synth.browsers(spark, dims.ua_rules_df(spark))
    assert b.count() == 100 and b.select("user_agent").distinct().count() == 100
    assert b.where("browser = 'Other'").count() == 0


def test_sizes_parents_and_determinism(spark):
    s = synth.Synth(5, AS_OF, "k", "s")
    v, x = s.visitors(spark), s.sections(spark)
    sess = s.routed_sessions(spark, synth.browsers(spark, dims.ua_rules_df(spark)))
    assert (v.count(), sess.count(), x.count()) == (100, 1000, 10000)
    assert v.select("id").distinct().count() == 100
    r = v.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    assert AS_OF - dt.timedelta(days=367) <= r.lo and r.hi <= AS_OF
    sec = x.select("api_key", "site", "ts", F.col("attrs")["parent"].alias("parent"),
                   F.lit("/").alias("path"), F.col("id"))
    fact = rollup.section_combined(sec, sess)
    assert fact.count() == 10000  # every page view finds its session
    again = synth.Synth(5, AS_OF, "k", "s").sections(spark)
    key = ["id", "ts", F.col("attrs")["parent"], F.col("attrs")["location"]]
    assert x.select(*key).exceptAll(again.select(*key)).count() == 0
    orphan = sess.join(v.select(F.col("id").alias("parent")), "parent", "left_anti").count()
    assert orphan == 0


def test_page_views_are_compiled_and_tasks_do_not_grow(spark, monkeypatch):
    import re
    x = synth.Synth(500, AS_OF, "k", "s").sections(spark)
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    sizes = re.findall(r"maxMethodCodeSize:\s*(\d+)", debug.codegenString(x._jdf.queryExecution().executedPlan()))
    assert sizes and max(map(int, sizes)) < 8000     # the JVM leaves longer methods to its interpreter
    monkeypatch.setattr(synth, "ROWS_PER_TASK", 1000)
    s = synth.Synth(5, AS_OF, "k", "s")
    assert s.sections(spark).rdd.getNumPartitions() == 10 and s.sections(spark).count() == 10000


def test_staged_hub_is_small_and_whole(spark):
    s, rules = synth.Synth(20, AS_OF, "k", "s"), dims.ua_rules_df(spark)
    hub = synth.staged_hub(s, spark, rules)
    want = s.event_hub(spark, synth.browsers(spark, rules))
    assert hub.columns == want.columns and hub.inputFiles()
    text = lambda df: df.withColumn("attrs", F.to_json("attrs"))
    assert text(hub).exceptAll(text(want)).isEmpty() and text(want).exceptAll(text(hub)).isEmpty()
    fs = spark._jvm.org.apache.hadoop.fs.Path(hub.inputFiles()[0]).getFileSystem(spark._jsc.hadoopConfiguration())
    size = sum(fs.getFileStatus(spark._jvm.org.apache.hadoop.fs.Path(f)).getLen() for f in hub.inputFiles())
    assert size < 110 * hub.count()


def test_actions_epochs(spark):
    rows = [("k", "c", i, dt.datetime(2024, 1, 1, 0, i), a, "https://h/p" if "S" in a[8:] or a == "registerClick" else None,
             "T" if a in ("registerSection", "registerClick") else None)
            for i, a in enumerate(["registerClick", "registerClick", "deregisterSession", "registerSection",
                                   "deregisterVisitor", "deregisterSection", "registerSession", "registerVisitor"])]
    df = spark.createDataFrame(rows, "api_key string, client string, seq long, ts timestamp, action string, "
                                     "location string, title string")
    ev = actions.from_actions(df, chunk=3).orderBy("seq", "sub").collect()
    kinds = [(r.seq, r.event_type) for r in ev]
    assert kinds == [(0, "Visitor"), (0, "Session"), (0, "Section"), (0, "Click"),
                     (1, "Click"),
                     (3, "Session"), (3, "Section"),
                     (6, "Visitor"), (6, "Session"),
                     (7, "Visitor")]
    by = {(r.seq, r.event_type): r for r in ev}
    assert by[(1, "Click")].parent == by[(0, "Section")].id
    assert by[(3, "Session")].parent == by[(0, "Visitor")].id  # same visitor, new session
    assert by[(6, "Session")].parent == by[(6, "Visitor")].id  # visitor removed -> recreated
    assert all(actions.valid_reference(F.lit(r.id)) is not None for r in ev)
    w = actions.to_wire(actions.from_actions(df)).where("sub = 2").first()
    assert w.t == 3 and set(w.a) == {"p", "l", "t"}


def plain_events(log):
    """The client, action by action: (seq, kind, creator's seq of the parent)."""
    cur, out = {}, []
    for seq, a in log:
        if a in (actions.REG_V, actions.DEREG_V):
            cur = {}
        elif a in (actions.REG_S, actions.DEREG_S):
            cur = {k: v for k, v in cur.items() if k == "Visitor"}
        elif a in (actions.REG_X, actions.DEREG_X):
            cur.pop("Section", None)
        for kind, parent in (("Visitor", None), ("Session", "Visitor"), ("Section", "Session")):
            if a in actions.CREATES[kind] and kind not in cur:
                cur[kind] = seq
                out.append((seq, kind, cur.get(parent)))
        if a == actions.REG_C:
            out.append((seq, "Click", cur["Section"]))
    return out


def test_one_pass_equals_the_client_step_by_step(spark):
    import random
    r = random.Random(4)
    logs = {f"c{k}": [(i, r.choice(actions.ACTIONS)) for i in range(0, n, 1 + k % 2)] for k, n in enumerate([400, 400, 90, 40, 7, 3, 1])}
    logs["starts late"] = [(i, actions.REG_C if i % 50 else actions.DEREG_X) for i in range(130, 330)]
    rows = [("k", c, i, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i), a, "https://h/p", "T") for c, log in logs.items() for i, a in log]
    df = spark.createDataFrame(rows, "api_key string, client string, seq long, ts timestamp, action string, location string, title string")
    want = sorted((c, *e) for c, log in logs.items() for e in plain_events(log))
    for chunk in (7, 64, 10 ** 6):
        ev = actions.from_actions(df.repartition(3), chunk=chunk).collect()
        seq_of = {(x.client, x.event_type, x.id): x.seq for x in ev}
        above = {"Session": "Visitor", "Section": "Session", "Click": "Section"}
        got = sorted((x.client, x.seq, x.event_type, seq_of.get((x.client, above.get(x.event_type), x.parent))) for x in ev)
        assert [tuple(map(str, x)) for x in got] == [tuple(map(str, x)) for x in want], chunk


def test_the_log_is_read_twice_at_most(spark, tmp_path):
    df = spark.createDataFrame([("k", "c", 1, AS_OF, actions.REG_C, "l", "t")], "api_key string, client string, seq long, ts timestamp, action string, location string, title string")
    df.write.parquet(str(tmp_path / "log"))
    ev = actions.from_actions(spark.read.parquet(str(tmp_path / "log")))
    plan = ev._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") <= 2 and plan.count("Exchange hashpartitioning") <= 4
    assert ev.count() == 4


def test_hub_in_parts_is_whole_and_small(spark, tmp_path):
    from webmetrics.operators import route
    from webmetrics.sources.staged import StagedHub
    s, rules = synth.Synth(20, AS_OF, "k", "s"), dims.ua_rules_df(spark)
    ids = [f"0190a0b0-c0d0-7000-8000-{n:012x}" for n in range(0xabc, 0xabc + 40)]
    odd = [lambda u: u, str.upper, lambda u: "{" + u + "}", lambda u: "urn:uuid:" + u, lambda u: u.replace("-", ""),
           lambda u: f" {u} ", lambda u: u + "\n", lambda u: "{" + u + "}\r\n", lambda u: u + "\u2028", lambda u: "none", lambda u: "", lambda u: None]
    late = [AS_OF, dt.datetime(1969, 12, 31, 23, 59, 59, 1), None]
    rows = [("k", "s", "Session", f(u), late[i % 3], {"parent": g(u), "user_agent": None, "ipv4": "1.2.3.4"})
            for i, u in enumerate(ids[:12]) for f, g in ((odd[0], odd[i % 12]), (odd[i % 12], odd[0]))]
    rows += [("k", "s", "Section", u, late[i % 3], {"parent": f(ids[i % 13]), "location": "https://h/p", "title": None})
             for i, u in enumerate(ids) for f in odd]
    some = spark.createDataFrame(rows, "api_key string, site string, event_type string, id string, ts timestamp, attrs map<string,string>")
    want = s.event_hub(spark, synth.browsers(spark, rules)).unionByName(some).cache()
    store = StagedHub(spark, str(tmp_path / "hub"), synth.HUB_ATTRS, 3).write(want)
    text = lambda df: df.withColumn("attrs", F.to_json(F.array_sort(F.map_entries("attrs"))))
    apart = [store.rows(k).cache() for k in range(3)]
    in_parts = apart[0].unionByName(apart[1]).unionByName(apart[2])
    for got in (store.rows(), in_parts):
        assert got.columns == want.columns
        assert text(got).exceptAll(text(want)).isEmpty() and text(want).exceptAll(text(got)).isEmpty()
    src = spark.createDataFrame([("k", "s")], "api_key string, site string")
    pairs = lambda hub: route.sections(hub, src).alias("x").join(
        route.sessions(hub, src).alias("s"), F.expr("x.parent = s.id")).selectExpr("x.id", "s.id AS sid", "s.parent", "x.ts")
    whole, one_by_one = pairs(want), pairs(apart[0]).unionByName(pairs(apart[1])).unionByName(pairs(apart[2]))
    assert whole.count() > 40_000 and one_by_one.exceptAll(whole).isEmpty() and whole.exceptAll(one_by_one).isEmpty()
    assert sum(f.stat().st_size for f in (tmp_path / "hub").rglob("*.parquet")) < 40 * want.count()
    for df in apart:
        df.unpersist()
    store.drop(2)
    assert not list((tmp_path / "hub").glob("*/part=2")) and store.rows(2).isEmpty() and not store.rows(1).isEmpty()


def test_combined_part_by_part(spark, tmp_path, monkeypatch):
    from webmetrics.plans import catalog, facts
    from webmetrics.sources import adapter, staged
    users, t0 = 12, dt.datetime(2024, 1, 1)
    spark.createDataFrame([(u, t0 + dt.timedelta(hours=u), u) for u in range(users)], "event_id long, ts timestamp, user_id long").write.parquet(str(tmp_path / "events.parquet"))
    for t in ("nation", "region"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    sf, rules = str(tmp_path), dims.ua_rules_df(spark)
    hub = catalog._synth(spark, sf).event_hub(spark, synth.browsers(spark, rules))
    want = facts.build(hub, adapter.api_keys(spark, sf), rules, facts.geo_blocks(spark, sf)).section_combined.cache()
    kept, drop = [], staged.StagedHub.drop
    monkeypatch.setattr(staged, "PART_ROWS", 10_000)
    monkeypatch.setattr(staged.StagedHub, "drop", lambda self, part: (drop(self, part), kept.append(self)))
    got = catalog.SPARK["synth_section_combined"](spark, sf)
    assert len(kept) == kept[0].parts == 3 and kept[0].rows().isEmpty()    # the hub's parts are gone, the rows are there
    assert got.columns == want.columns and got.count() == 2000 * users
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
