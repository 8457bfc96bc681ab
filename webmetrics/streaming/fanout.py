"""Streaming view of the operators (K1-K6, K8).

* K1  ``start_fan_out``: request files/messages -> ingest validation
      (stateless, stream-static broadcast join with the sources) ->
      ``foreachBatch`` that persists the batch once and writes every typed
      table and fact. Each batch writes under ``batch=<id>`` with overwrite,
      so a re-run of a batch after a failure replaces its own output
      (idempotent by batch id); readers see one table per name.
* K2/K3: each batch writes what it adds to the joins over all stored rows, so
      nothing is lost when a session comes after its page views;
      ``section_session_join`` is the stream-stream alternative with a
      watermark and a time bound, ``hierarchy_links`` that of all three streams, whose
      links beyond the bound are closed from the stored tables.
* K4  ``visitor_counts``: 5-minute tumbling window in update mode; the newest row of
      a window counts.
* K5  lateness is refused at the door (B7); the watermark covers what may still come.
* K6 ``Refreshing``: dimensions re-read when older than their lifetime; K8: keys with times of
      validity are looked up as of the receipt, so a batch run again decides alike.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webmetrics.functions.ids import uuid7_ts
from webmetrics.operators import enrich, ingest, rollup, route
from webmetrics.sources import dims, incremental, sinks

KEY_TTL = 60.0      # seconds, key dictionary lifetime
GEO_TTL = 3600.0    # seconds, geo dictionary lifetime


class Refreshing:
    """A dimension DataFrame re-read by ``loader`` when older than ``ttl`` seconds."""

    def __init__(self, loader: Callable[[], DataFrame], ttl: float):
        self.loader, self.ttl = loader, ttl
        self._df: DataFrame | None = None
        self._at = 0.0

    def get(self) -> DataFrame:
        now = time.monotonic()
        if self._df is None or now - self._at >= self.ttl:
            self._df = self.loader()
            self._at = now
        return self._df


def _batch_path(root: str, table: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/{table}/batch={batch_id}"


def _stored(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All stored batches of ``table``."""
    return sinks.read_table(spark, f"{root.rstrip('/')}/{table}", table, ("batch",)).drop("batch", "event_date")


def fan_out_batch(batch: DataFrame, batch_id: int, root: str, api_keys: Refreshing,
                  rules: DataFrame, blocks: Refreshing, geo_mode: str = "range") -> None:
    """One micro-batch of request rows -> all tables.

    The batch is validated once, against the keys as they are now or, if they are changes with
    times (K8), as of each request's receipt. Refused events go to a table of their
    own. Its page views join the sessions stored so far,
    earlier page views its sessions (:func:`sinks.write_facts`), so the facts are
    those of one join over all batches, in whatever order the events arrive.
    """
    spark = batch.sparkSession
    keys = api_keys.get()
    known = dims.key_versions(keys) if "valid_from" in keys.columns else dims.sources(dims.api_key_latest(keys))
    src = known.select("api_key", "site").distinct()
    batch = batch.persist()
    res = ingest.validate(batch, known)
    hub = ingest.hub(res).persist()
    try:
        visitor = route.visitors(hub, src)
        session = enrich.enrich_sessions(route.sessions(hub, src), rules, blocks.get(), geo_mode)
        section = route.sections(hub, src)
        for table, df in [("visitor_event", visitor), ("session_event", session),
                          ("section_event", section)]:
            sinks.write_table(df, _batch_path(root, table, batch_id), table, "overwrite")
        res.summary.write.mode("overwrite").parquet(_batch_path(root, "request_summary", batch_id))
        res.quarantine.write.mode("overwrite").parquet(_batch_path(root, "request_quarantine", batch_id))
        sinks.write_facts(spark, root, batch_id)
    finally:
        hub.unpersist()
        batch.unpersist()


def start_fan_out(requests_stream: DataFrame, root: str, checkpoint: str, api_keys: Refreshing,
                  rules: DataFrame, blocks: Refreshing, trigger: dict | None = None,
                  geo_mode: str = "range"):
    """K1: start the checkpointed fan-out query; returns the StreamingQuery."""
    w = (requests_stream.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, bid: fan_out_batch(df, bid, root, api_keys, rules, blocks, geo_mode)))
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def read_tables(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All batches of a fan-out table as one DataFrame."""
    if table in sinks.TABLE_SCHEMAS:
        return _stored(spark, root, table)
    return spark.read.parquet(f"{root.rstrip('/')}/{table}").drop("batch", "event_date")


def _started(writer, spark: SparkSession, trigger: dict | None):
    """Starts a query with state in as many partitions as there are cores, at most as shuffles have:
    each partition writes files for each of its stores (four a join) in every batch, and the watermarks
    bound the state. The number stays with the checkpoint."""
    name = "spark.sql.shuffle.partitions"
    usual = spark.conf.get(name)
    spark.conf.set(name, str(min(int(usual), spark.sparkContext.defaultParallelism)))
    try:
        return writer.trigger(**(trigger or {"availableNow": True})).start()      # takes a copy of the settings
    finally:
        spark.conf.set(name, usual)


def validated_events(requests_stream: DataFrame, sources_df: DataFrame) -> DataFrame:
    """Stateless validation of a request stream -> accepted hub events (K1, K5)."""
    return ingest.hub(ingest.validate(requests_stream, sources_df))


def visitor_counts(events_stream: DataFrame, lateness: str = "65 minutes") -> DataFrame:
    """K4: visitors per (api_key, site, 5-minute window), final once the watermark
    passes the window end. An accepted event is less than an hour older than its receipt
    and less than five minutes newer (B7), so of a source read in order of receipt
    the watermark refuses nothing."""
    v = events_stream.where(F.col("event_type") == "Visitor")
    return (v.withWatermark("ts", lateness)
             .groupBy("api_key", "site", F.window("ts", "5 minutes").alias("w"))
             .agg(F.count(F.lit(1)).alias("visitors"))
             .select("api_key", "site", F.col("w.start").alias("ts"), "visitors"))


def start_visitor_counts(events_stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """K4 as a table: each batch writes the windows it changed below ``batch=<id>`` (update
    mode, so the state of closed windows goes); a batch run again replaces its own."""
    w = (visitor_counts(events_stream).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, bid: df.write.mode("overwrite").parquet(f"{path}/batch={bid}")))
    return _started(w, events_stream.sparkSession, trigger)


def read_visitor_counts(spark: SparkSession, path: str) -> DataFrame:
    """The newest count of each window."""
    rows = spark.read.schema("api_key string, site string, ts timestamp, visitors long, batch long").parquet(path)
    return rows.groupBy("api_key", "site", "ts").agg(F.max_by("visitors", "batch").alias("visitors"))


def section_session_join(sections: DataFrame, sessions: DataFrame, lateness: str = "1 hour",
                         max_session: str = "24 hours") -> DataFrame:
    """K2 (stream-stream): inner join of page views with their session, with
    watermarks on both sides and the time bound
    ``session.ts <= section.ts <= session.ts + max_session``, so state is
    bounded and a session arriving after its page views still joins."""
    s = (sessions.withWatermark("ts", lateness)
         .select(F.col("api_key").alias("s_api_key"), F.col("site").alias("s_site"),
                 F.col("id").alias("s_id"), F.col("ts").alias("s_ts"), "os", "browser",
                 "country_code", "city", F.col("parent").alias("visitor")))
    x = sections.withWatermark("ts", lateness)
    cond = ((x.api_key == s.s_api_key) & (x.site == s.s_site) & (x.parent == s.s_id)
            & (x.ts >= s.s_ts) & (x.ts <= s.s_ts + F.expr(f"INTERVAL {max_session}")))
    j = x.join(s, cond, "inner")
    return j.select("api_key", "site", rollup.bucket5("ts").alias("ts"), "path", "os", "browser",
                    "country_code", "city", "visitor")


# --------------------------------------------------------------------------- K3 over three streams

#: Time between an event and its parent up to which the joins wait for each other in state.
NEAR = "2 hours"
_LINK = "api_key string, site string, visitor string, session string, section string, ts timestamp, batch long"


def hierarchy_links(sections: DataFrame, sessions: DataFrame, visitors: DataFrame, near: str = NEAR,
                    lateness: str = "65 minutes") -> DataFrame:
    """K3 (three streams): page views left-joined with their session, then with its visitor.

    A parent's id names its time, so a page view knows on arrival whether its parent is
    within ``near``: such rows wait in state, bounded by the watermarks, for a parent that
    is as late; all others pass at once with nulls, and so do those whose parent did not
    come when their state goes. A row is a finished chain where ``found``; the others are to be
    joined with the stored tables (:func:`start_hierarchy`). An accepted event
    is less than ``lateness`` behind the newest (B7), so of sources read in order of receipt
    the watermarks refuse nothing.
    """
    gap = F.expr(f"INTERVAL {near}")

    def close(parent):
        return F.coalesce((uuid7_ts(parent) >= F.col("ts") - gap) & (uuid7_ts(parent) <= F.col("ts") + gap), F.lit(False))

    x = sections.select("api_key", "site", F.col("id").alias("section"), F.col("parent").alias("session"), "ts").withWatermark("ts", lateness)
    s = sessions.select(F.col("api_key").alias("s_key"), F.col("site").alias("s_site"), F.col("id").alias("s_id"),
                        F.col("parent").alias("visitor"), F.col("ts").alias("s_ts")).withWatermark("s_ts", lateness)
    v = visitors.select(F.col("api_key").alias("v_key"), F.col("site").alias("v_site"), F.col("id").alias("v_id"),
                        F.col("ts").alias("v_ts")).withWatermark("v_ts", lateness)
    bound = lambda t: (F.col(t) >= F.col("ts") - gap) & (F.col(t) <= F.col("ts") + gap)
    one = x.join(s, (x.api_key == s.s_key) & (x.site == s.s_site) & (x.session == s.s_id) & close(F.col("session")) & bound("s_ts"), "left_outer")
    one = one.select("api_key", "site", "section", "session", "ts", "visitor")
    two = one.join(v, (one.api_key == v.v_key) & (one.site == v.v_site) & (one.visitor == v.v_id) & close(F.col("visitor")) & bound("v_ts"), "left_outer")
    return two.select("api_key", "site", "visitor", "session", "section", "ts", F.col("v_id").isNotNull().alias("found"))


def resolved(rows: DataFrame, stored: str) -> DataFrame:
    """Open links with the stored parents (tables below ``stored``) of the days that their ids
    name: session and visitor where known, and ``found``."""
    spark, keys = rows.sparkSession, ["api_key", "site"]

    def parents(table, children, col):
        path = f"{stored}/{table}"
        days = incremental.days_named(children.where(F.col(col).isNotNull()), incremental.day_of(col), sinks.stored_days(spark, path))
        return sinks.read_days(spark, path, table, days)

    unmet = rows.where("visitor is null").select(*keys, "session", "section", "ts")
    s = parents("session_event", unmet, "session").select(*keys, F.col("id").alias("session"), F.col("parent").alias("visitor"))
    links = unmet.join(s, [*keys, "session"], "left").unionByName(rows.where("visitor is not null").select(*keys, "visitor", "session", "section", "ts"))
    v = parents("visitor_event", links, "visitor").select(*keys, F.col("id").alias("visitor"), F.lit(True).alias("found"))
    return links.join(v, [*keys, "visitor"], "left").select(*keys, "visitor", "session", "section", "ts", F.coalesce("found", F.lit(False)).alias("found"))


def start_hierarchy(links: DataFrame, root: str, checkpoint: str, stored: str, trigger: dict | None = None):
    """The links as two tables below ``root``, a folder per batch (a batch run again replaces its
    own): ``chains``, finished in state or by a stored parent, and ``open`` ones, whose
    parents are not stored yet either."""
    def store(df, bid):
        df = df.persist()
        rest = resolved(df.where("not found").drop("found"), stored).persist()
        try:
            done = df.where("found").unionByName(rest.where("found")).drop("found")
            done.write.mode("overwrite").parquet(f"{root}/chains/batch={bid}")
            rest.where("not found").drop("found").write.mode("overwrite").parquet(f"{root}/open/batch={bid}")
        finally:
            rest.unpersist()
            df.unpersist()

    w = links.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(store)
    return _started(w, links.sparkSession, trigger)


def read_hierarchy(spark: SparkSession, root: str, stored: str) -> DataFrame:
    """All chains: the finished ones, and open links whose parents have been stored since."""
    chains, rest = [spark.read.schema(_LINK).parquet(f"{root}/{t}").drop("batch") for t in ("chains", "open")]
    return chains.unionByName(resolved(rest, stored).where("found").drop("found"))
