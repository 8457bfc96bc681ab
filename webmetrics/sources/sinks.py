"""Table writers (A3-A8, A14), incremental facts (K2/K3), compaction (F4) and retention (K7).

Layout of every table: Parquet (zstd), partitioned by (site, event_date),
rows range-partitioned and sorted by the table's key so that

* partition pruning works on site / date predicates,
* Parquet min/max statistics skip row groups on the sort key,
* a site-day holding a large share of all rows is split across several
  tasks: rows are shuffled with the REBALANCE hint on the partition columns,
  and AQE splits oversized (skewed) shuffle partitions and merges small
  ones into advisory-size tasks. Unlike a range repartition this needs no
  sampling pass, which would re-run the whole upstream plan once more.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from webmetrics import schema as S
from webmetrics.operators import rollup
from webmetrics.sources import incremental, snapshots
from webmetrics.sources.snapshots import batches


@dataclass(frozen=True)
class Layout:
    sort: tuple[str, ...]
    partition: tuple[str, ...] = ("site", "event_date")
    bloom: tuple[str, ...] = ()


LAYOUTS = {
    "visitor_event": Layout(("api_key", "site", "id")),
    "session_event": Layout(("api_key", "site", "id")),
    # clustered by parent first: the E1 join key (quirk Q14)
    "section_event": Layout(("api_key", "site", "parent", "id")),
    "hierarchy_event": Layout(("api_key", "site", "visitor", "session", "section")),
    "section_combined": Layout(("api_key", "site", "ts"), bloom=("city",)),
    "visitor_timeseries": Layout(("api_key", "site", "ts")),
    # bronze hub: event_type first, so each route reads only its own slice
    "event": Layout(("api_key", "site", "id"), partition=("event_type", "event_date")),
}


#: Stored daily rollups (F6-F11) and their dimensions.
DAILY = {"daily_by_browser": "browser", "daily_by_city": "city", "daily_by_country": "country_code",
         "daily_by_os": "os", "daily_by_path": "path", "daily_total": None}
LAYOUTS |= {n: Layout(("api_key", "site", d) if d else ("api_key", "site")) for n, d in DAILY.items()}


def with_event_date(df: DataFrame) -> DataFrame:
    return df.withColumn("event_date", F.to_date("day" if "day" in df.columns else "ts"))


def write_table(df: DataFrame, path: str, table: str, mode: str = "append",
                num_partitions: int | None = None) -> None:
    """Write ``df`` as ``table`` under ``path``.

    mode: 'append' | 'overwrite' (whole table) | 'dynamic' (replace only the
    partitions present in ``df``: re-running a batch is idempotent).
    """
    lay = LAYOUTS[table]
    out = with_event_date(df)
    keys = [*lay.partition, *[c for c in lay.sort if c not in lay.partition]]
    if num_partitions:
        out = out.hint("rebalance", num_partitions, *lay.partition)
    else:
        out = out.hint("rebalance", *lay.partition)
    out = out.sortWithinPartitions(*keys)
    w = out.write.partitionBy(*lay.partition)
    for c in lay.bloom:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    if mode == "dynamic":
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        w = w.mode(mode)
    w.parquet(path)


TABLE_SCHEMAS = {
    "visitor_event": S.VISITOR_EVENT, "session_event": S.SESSION_EVENT,
    "section_event": S.SECTION_EVENT, "hierarchy_event": S.HIERARCHY_EVENT,
    "section_combined": S.SECTION_COMBINED, "visitor_timeseries": S.VISITOR_TIMESERIES,
}
for _name, _dim in DAILY.items():
    _keys = T.StructType().add("api_key", "string").add("site", "string").add("day", "timestamp")
    TABLE_SCHEMAS[_name] = (_keys.add(_dim, "string") if _dim else _keys).add("page_views", "long").add("visitors_sketch", "binary")


def read_table(spark: SparkSession, path: str, table: str | None = None,
               extra_partitions: tuple[str, ...] = ()) -> DataFrame:
    """Read a written table. With ``table`` the schema is given (no inference,
    and a table with no files yet reads as empty). With ``batch`` among the extra
    partitions it is a table of batches, read as its newest manifest has it."""
    if table is None:
        return spark.read.parquet(path)
    if "batch" in extra_partitions:
        return snapshots.read(spark, path, TABLE_SCHEMAS[table])
    sch = T.StructType(list(TABLE_SCHEMAS[table].fields)
                       + [T.StructField(c, T.LongType()) for c in extra_partitions]
                       + [T.StructField("event_date", T.DateType())])
    return spark.read.schema(sch).parquet(path)


def write_model(model, root: str, mode: str = "append", batch_id: int | None = None, daily: bool = False) -> dict[str, str]:
    """Write the typed tables, then derive the facts from the *stored*
    typed tables (as the reference's views read stored tables).

    ``append`` writes one batch below ``<table>/batch=<id>``: its own hub rows,
    typed rows and what they add to the facts (:func:`write_facts`). Writing a
    batch again replaces it; without an id it gets the next free one.
    ``overwrite`` replaces whole tables (no batch folders); a root is filled by
    one of the two. ``daily`` also writes the daily rollups (:func:`write_daily`).

    Reading back cuts the lineage: the enrichment of sessions runs once, not
    once per fact, and a lost executor only re-runs the stage at hand.
    """
    spark = model.event.sparkSession
    root = root.rstrip("/")
    paths = {n: f"{root}/{n}" for n in LAYOUTS}
    if mode == "append":
        upto = snapshots.manifest(spark, paths["section_event"]).upto
        batch = max([upto, *batches(spark, paths["section_event"])]) + 1 if batch_id is None else batch_id
        if batch <= upto:
            return paths        # compacted, so written in full: final
        at = {n: f"{p}/batch={batch}" for n, p in paths.items()}
    else:
        batch, at = None, paths
    if model.rules_df is not None:
        # bronze hub first: the raw input is read and shaped once; routing and
        # enrichment then read the stored hub (partition-pruned by event_type)
        write_table(model.event, at["event"], "event", "overwrite")
        model = model.rebuild(read_table(spark, at["event"]).drop("event_date"))
    for name, df in [("visitor_event", model.visitor), ("session_event", model.session),
                     ("section_event", model.section)]:
        write_table(df, at[name], name, "overwrite")
    write_facts(spark, root, batch)
    if daily:
        write_daily(spark, root, batch)
    return paths


def stored_days(spark: SparkSession, path: str, batch: int | None = None) -> set[int]:
    """Day numbers of a batch table's event_date folders, or those of the batches before one
    (names only, no file is read)."""
    m = snapshots.manifest(spark, path)
    names = []
    if batch is None:
        names += incremental.subfolders(spark, f"{path}/batch=*/site=*", "event_date")
    elif earlier := [str(b) for b in batches(spark, path) if m.upto < b < batch]:
        names += incremental.subfolders(spark, f"{path}/batch={{{','.join(earlier)}}}/site=*", "event_date")
    if m.base:
        names += incremental.subfolders(spark, f"{path}/{m.base}/batch=*/site=*", "event_date")
    return {(dt.date.fromisoformat(n) - dt.date(1970, 1, 1)).days for n in names if n[:1].isdigit()}


def read_days(spark: SparkSession, path: str, table: str, days, batch: int | None = None) -> DataFrame:
    """Rows of some days (and of batches before one): the other days' files are pruned."""
    dates = [dt.date(1970, 1, 1) + dt.timedelta(days=d) for d in sorted(days)]
    rows = read_table(spark, path, table, ("batch",)).where(F.col("event_date").isin(dates))
    return (rows if batch is None else rows.where(F.col("batch") < batch)).drop("batch", "event_date")


def write_facts(spark: SparkSession, root: str, batch: int | None) -> None:
    """Write what a batch adds to the facts, from the stored typed tables.

    The facts are inner joins, kept up to date by :mod:`webmetrics.sources.incremental`: a batch
    reads its own rows, the stored parents of the days that its ids name, and the earlier page
    views that still wait for one of its parents. Whatever the order in which parents
    and children arrive, the batches together hold the rows of one join over
    everything, each once; and a batch that is written again yields the same
    rows. ``None``: whole tables without batch folders.
    """
    root = root.rstrip("/")
    names = ("section_event", "session_event", "visitor_event")
    paths = {n: f"{root}/{n}" for n in LAYOUTS}
    at = paths if batch is None else {n: f"{p}/batch={batch}" for n, p in paths.items()}
    sec, ses, vis = [read_table(spark, at[n], n).drop("event_date") for n in names]
    facts = [("visitor_timeseries", rollup.visitor_timeseries(vis))]
    if batch is None:
        facts += [("hierarchy_event", rollup.hierarchy(sec, ses, vis)), ("section_combined", rollup.section_combined(sec, ses))]
        for name, df in facts:
            write_table(df, at[name], name, "overwrite")
        return
    # stored, not cached: a cached plan keeps every shuffle partition as a task of its own, each of
    # which writes to every partition of the next shuffle, so both grow as their product
    staged = f"{root}/staged-pairs-{uuid.uuid4().hex}"
    try:
        _added_pairs(spark, root, batch, sec, ses).write.parquet(staged)
        pairs = spark.read.schema(PAIRS).parquet(staged)
        facts += [("hierarchy_event", _added_chains(spark, root, batch, pairs, vis)),
                  ("section_combined", pairs.select(*[rollup.bucket5("ts").alias("ts") if c == "ts" else c for c in rollup.FACT_COLS]))]
        for name, df in facts:
            write_table(df, at[name], name, "overwrite")
    finally:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staged)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


#: Link tables: page views by their session's day, and those with a session by its visitor's.
SECTION_LINK, SESSION_LINK = "section_link", "session_link"

#: New pairs of a batch, as staged for both facts.
PAIRS = T.StructType([T.StructField(c, T.TimestampType() if c == "ts" else T.StringType()) for c in (
    "api_key", "site", "parent", "section", "ts", "path", "os", "browser", "country_code", "city", "visitor")])


def _added_pairs(spark: SparkSession, root: str, batch: int, sec: DataFrame, ses: DataFrame) -> DataFrame:
    """New pairs of page view and session (E1 before its rounding of ts)."""
    def parents(s):
        return s.select("api_key", "site", F.col("id").alias("parent"), "os", "browser", "country_code", "city", F.col("parent").alias("visitor"))

    path = f"{root}/session_event"
    children = sec.select("api_key", "site", F.col("id").alias("section"), "parent", "ts", "path")
    return incremental.added(spark, f"{root}/{SECTION_LINK}", batch, children, parents(ses), stored_days(spark, path, batch),
                             lambda days: parents(read_days(spark, path, "session_event", days, batch)))


def _added_chains(spark: SparkSession, root: str, batch: int, pairs: DataFrame, vis: DataFrame) -> DataFrame:
    """New chains of page view, session and visitor (E3) from the new pairs."""
    def parents(v):
        return v.select("api_key", "site", F.col("id").alias("parent"))

    path = f"{root}/visitor_event"
    children = pairs.select("api_key", "site", "section", F.col("parent").alias("session"), F.col("visitor").alias("parent"), "ts")
    rows = incremental.added(spark, f"{root}/{SESSION_LINK}", batch, children, parents(vis), stored_days(spark, path, batch),
                             lambda days: parents(read_days(spark, path, "visitor_event", days, batch)))
    return rows.select("api_key", "site", F.col("parent").alias("visitor"), "session", "section", "ts")


def write_daily(spark: SparkSession, root: str, batch: int | None, names=tuple(DAILY)) -> None:
    """The daily rollups of a batch's stored fact rows, with a sketch of the
    visitors. Rows of several batches for one day add up (sums, union of sketches), as
    ``report.from_daily`` does; a batch written again replaces its own."""
    at = lambda n: f"{root.rstrip('/')}/{n}" + ("" if batch is None else f"/batch={batch}")
    fact = read_table(spark, at("section_combined"), "section_combined").drop("event_date")
    for name in names:
        write_table(rollup.daily(fact, DAILY[name], sketch=True), at(name), name, "overwrite")


def compact_timeseries(spark: SparkSession, path: str, out_path: str) -> None:
    """merge partial rows with equal (api_key, site, ts) into one row.

    Written to a new location (a table cannot be overwritten while it is
    read); the caller swaps locations. Sums are unchanged by construction.
    """
    merged = rollup.merge_timeseries(read_table(spark, path).drop("event_date"))
    write_table(merged, out_path, "visitor_timeseries", "overwrite")


def compact(spark: SparkSession, root: str, names=None, upto: int | None = None) -> dict[str, snapshots.Manifest]:
    """The batch folders (up to a batch) of each table of ``root`` become one, in the table's
    layout; partial sums of a bucket and rollup rows of a day are merged on the way.
    Readers go from the old files to the new ones by the manifest, a table at a time."""
    root, out = root.rstrip("/"), {}
    for name in names or [n for n in TABLE_SCHEMAS if batches(spark, f"{root}/{n}")]:
        merge = rollup.merge_timeseries if name == "visitor_timeseries" else _merged_daily if name in DAILY else None
        out[name] = snapshots.compact(spark, f"{root}/{name}", TABLE_SCHEMAS[name],
                                      lambda df, at, name=name: write_table(df, at, name, "overwrite"), merge, upto)
    return out


def _merged_daily(df: DataFrame) -> DataFrame:
    """Rollup rows of one day and value as one: sums, and the union of the visitor sketches."""
    keys = [c for c in df.columns if c not in ("page_views", "visitors_sketch")]
    return df.groupBy(*keys).agg(F.sum("page_views").cast("long").alias("page_views"), F.hll_union_agg("visitors_sketch").alias("visitors_sketch"))


def backfill(staged: dict[str, DataFrame], root: str) -> None:
    """Replace the target tables with staged rows (truncate + insert)."""
    for name, df in staged.items():
        write_table(df, f"{root.rstrip('/')}/{name}", name, "overwrite")


# --------------------------------------------------------------------------- retention

def retained(df: DataFrame, as_of, keep: str = "7 days") -> DataFrame:
    """K7 (query-time): rows whose ``ts + keep`` is still after ``as_of``."""
    from webmetrics.functions.timefn import utc_lit
    return df.where(F.col("ts") + F.expr(f"INTERVAL {keep}") > utc_lit(as_of))


def expire_partitions(spark: SparkSession, path: str, as_of, keep_days: int = 7) -> list[str]:
    """K7 (storage): delete ``event_date`` partitions that are wholly expired.

    A day D is wholly expired when D + 1 day + keep <= as_of. Rows of the
    partly expired boundary day stay and are hidden by :func:`retained`. Readers that
    are under way may miss files; :func:`snapshots.expire` takes days out of every read
    first and leaves the files to a later vacuum.
    Uses the Hadoop FileSystem of the table path (works on any shared store).
    """
    from webmetrics.functions.timefn import to_dt
    cutoff = (to_dt(as_of) - dt.timedelta(days=keep_days + 1)).date()
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    dropped = []
    if not fs.exists(root):
        return dropped
    folders = [root]
    while folders:      # event_date folders lie below site, or below batch and site
        for d in fs.listStatus(folders.pop()):
            name = d.getPath().getName()
            if d.isDirectory() and not name.startswith("event_date="):
                folders.append(d.getPath())
            elif d.isDirectory() and dt.date.fromisoformat(name.split("=", 1)[1]) <= cutoff:
                fs.delete(d.getPath(), True)
                dropped.append(str(d.getPath()))
    return dropped


# --------------------------------------------------------------------------- bucketing

BUCKET_KEYS = {
    "session_event": ("api_key", "site", "id"),
    "section_event": ("api_key", "site", "parent"),
    "visitor_event": ("api_key", "site", "id"),
}


def write_bucketed(df: DataFrame, table: str, name: str, num_buckets: int,
                   path: str | None = None, mode: str = "overwrite") -> None:
    """Write a typed table bucketed (and sorted) on its join key into the
    catalog as ``name``. Session and page-view tables written with the same
    bucket count join on (api_key, site, id = parent) without shuffling
    either side; the id in the key spreads a hot tenant over all buckets."""
    keys = BUCKET_KEYS[table]
    w = df.write.mode(mode).format("parquet").bucketBy(num_buckets, *keys).sortBy(*keys)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
