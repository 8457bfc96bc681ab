"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries": {...}, "sf"}.

Phases (each query forced with the no-op sink, warm, median of
$BENCH_REPS runs after one warm-up):
  * facts_build    events -> typed tables + facts written as Parquet
                   (the batch view cascade, A3-A8)
  * g1..g8         the eight reports over the *materialised* facts, which is
                   how reports are served (they never join)
  * e1_fact, e3_hierarchy, d_enrich, b_ingest   end-to-end plans from raw
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    from webmetrics.session import checkpoint_dir, get_spark
    spark = get_spark(f"local[{cpus}]", app="webmetrics-bench", shuffle_partitions=int(cpus) * 2)

    from webmetrics.operators import report
    from webmetrics.plans import catalog
    from webmetrics.plans.facts import driver_model
    from webmetrics.sources import sinks

    def force(df):
        df.write.format("noop").mode("overwrite").save()

    def timed(fn, n=reps):
        fn()  # warm-up
        xs = []
        for _ in range(n):
            t = time.perf_counter()
            fn()
            xs.append(time.perf_counter() - t)
        return round(statistics.median(xs), 3)

    out: dict[str, float] = {}
    base = checkpoint_dir(spark)
    root = tempfile.mkdtemp(prefix="bench-tables-", dir=base if base.startswith("/") else None)

    def build():
        m = driver_model(spark, sf_dir)
        sinks.write_model(m, root, mode="overwrite")

    out["facts_build"] = timed(build, max(1, reps - 1))
    fact = spark.read.parquet(f"{root}/section_combined")
    vts = spark.read.parquet(f"{root}/visitor_timeseries")
    K, S = catalog.KEYS, catalog.SITES
    rc = catalog.REPORT_CASES
    qs = {
        "g1_by_country": lambda: report.by_country(fact, K, S, **rc["report_by_country"][1]),
        "g2_timeseries_hour": lambda: report.timeseries(fact, K, S, "2024-01-05", "2024-01-15"),
        "g3_total_visitors": lambda: report.total_visitors(fact, K, S, **rc["report_total_visitors"][1]),
        "g4_by_browser": lambda: report.by_browser(fact, K, S, **rc["report_by_browser"][1]),
        "g5_by_os": lambda: report.by_os(fact, K, S),
        "g6_by_path": lambda: report.by_path(fact, K, S, **rc["report_by_path"][1]),
        "g7_by_city": lambda: report.by_city(fact, K, S, **rc["report_by_city"][1]),
        "g8_visitor_timeseries": lambda: report.visitor_timeseries(vts, K, S, "2024-01-01", "2024-01-31"),
    }
    for name, mk in qs.items():
        out[name] = timed(lambda mk=mk: force(mk()))
    raw = {
        "e1_fact": "section_combined", "e3_hierarchy": "hierarchy",
        "d_enrich": "session_enriched", "b_ingest": "request_summary",
    }
    for name, q in raw.items():
        out[name] = timed(lambda q=q: force(catalog.SPARK[q](spark, sf_dir)))
    total = round(sum(out.values()), 3)
    extra = {} if os.environ.get("BENCH_EXTRA", "1") == "0" else extras(spark, sf_dir, out, timed, force)
    print(json.dumps({"metric": "total_seconds_headline_queries", "value": total, "unit": "sec",
                      "queries": out, "extra": extra, "sf": os.path.basename(sf_dir).replace("sf", ""),
                      "cpus": int(cpus), "reps": reps}))
    spark.stop()


def extras(spark, sf_dir, out, timed, force) -> dict:
    """
    ingest events/s, distinct-first vs row-wise UA parsing, streaming
    throughput (availableNow over request files), E1/E3 on a synthetic
    BASE = 500 tenant (1 M page views)."""
    import datetime as dt

    from pyspark.sql import functions as F

    from webmetrics import schema as S
    from webmetrics.operators import enrich, route, synth
    from webmetrics.plans import catalog, facts
    from webmetrics.sources import adapter, dims
    from webmetrics.streaming import fanout

    ex: dict = {}
    n_events = adapter.read(spark, sf_dir, "events").count()
    ex["ingest_events_per_sec"] = round(n_events / out["b_ingest"], 1)
    m = facts.driver_model(spark, sf_dir)
    raw = route.sessions(m.event, m.sources)
    rules = dims.ua_rules_df(spark)
    d1 = timed(lambda: force(enrich.user_agents(raw, rules)), 2)
    d2 = timed(lambda: force(enrich.user_agents(raw, rules, distinct_first=False)), 2)
    ex["ua_distinct_first_sec"], ex["ua_rowwise_sec"] = d1, d2
    ex["ua_rowwise_over_distinct"] = round(d2 / d1, 2) if d1 else None
    run = catalog._stream_source(spark, sf_dir, in_order=True)
    stream = spark.readStream.schema(S.REQUEST).option("maxFilesPerTrigger", 2).json(f"{run}/requests")
    events = fanout.validated_events(stream, catalog._sources(spark, sf_dir))
    t = time.perf_counter()
    fanout.start_visitor_counts(events, f"{run}/vc", f"{run}/ckpt").awaitTermination()
    ex["k4_stream_sec"] = round(time.perf_counter() - t, 3)
    ex["k4_stream_events_per_sec"] = round(n_events / ex["k4_stream_sec"], 1)
    s = synth.Synth(500, dt.datetime(2024, 2, 1), "key-0", "site0.example.com")
    t = time.perf_counter()
    hub = synth.staged_hub(s, spark, rules)
    ex["synth_base500_stage_sec"] = round(time.perf_counter() - t, 3)
    sm = facts.build(hub, adapter.api_keys(spark, sf_dir), rules, facts.geo_blocks(spark, sf_dir))
    ex["e1_synth_1m_sec"] = timed(lambda: force(sm.section_combined), 1)
    ex["e3_synth_1m_sec"] = timed(lambda: force(sm.hierarchy), 1)
    ex["synth_page_views"] = sm.section.select(F.count(F.lit(1))).first()[0]
    return ex


if __name__ == "__main__":
    main()
