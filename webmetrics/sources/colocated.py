"""Typed tables stored by the id that joins them, so E1 and E3 shuffle nothing.

All tables of a store are bucketed on (api_key, site, joining id) with one number of buckets:

    <root>/<table>/folder=<day that the joining id names>/batch=<id>/<one file a bucket>

    visitor_event       by id
    session_event       by id          what page views look up (E1)
    session_by_visitor  by parent      what visitors are looked up for (E8)
    session_known       by id          sessions whose visitor exists (E8), what chains look up (E3)
    section_event       by parent

A row is shuffled once, when it is written; every join after that reads bucket by bucket. E3's
second join would need its first one's rows by visitor; ``session_known`` holds its result by
session instead, so both joins of the chain are co-located. A batch joins its own children with
the stored parents of the days they name, and earlier children below its parents' days with
its parents (as :mod:`webmetrics.sources.incremental`), so it reads no other days.

A bucket holds whole ids. A parent with more than ``HOT_ROWS`` children in a batch would make its
bucket a slow task: such children lie in ``<table>_hot``, not bucketed, and meet their
parents, of which there is one per hot id, by a broadcast behind a check of its size (beyond it
by a shuffle join that AQE splits). Ids of parents are unique by design; repeated ones join as
often as they come, but share a bucket.

The number of buckets is kept in the store and can't be changed. A batch that is written again
replaces its own rows and yields the same ones.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webmetrics import schema as S
from webmetrics.functions.timefn import bucket5
from webmetrics.operators import rollup
from webmetrics.plans.strategy import checked_broadcast
from webmetrics.sources import incremental, sinks

HOT_ROWS = 1_000_000
_KNOWN = T.StructType().add("api_key", "string").add("site", "string").add("id", "string").add("visitor", "string")
#: Columns and joining id of each table.
TABLES = {
    "visitor_event": (S.VISITOR_EVENT, "id"),
    "session_event": (S.SESSION_EVENT, "id"),
    "session_by_visitor": (S.SESSION_EVENT, "parent"),
    "session_known": (_KNOWN, "id"),
    "section_event": (S.SECTION_EVENT, "parent"),
}


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    root: str
    buckets: int

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def name(self, table: str) -> str:
        return f"colocated_{hashlib.sha256(self.root.encode()).hexdigest()[:16]}_{table}"

    def read(self, table: str, folders=None, batch: int | None = None, before: bool = False) -> DataFrame:
        """Rows of a table, of some folders, of a batch or those before it."""
        df = self.spark.table(self.name(table))
        if folders is not None:
            df = df.where(F.col("folder").isin([int(f) for f in folders]))
        if batch is not None:
            df = df.where(F.col("batch") < batch if before else F.col("batch") == batch)
        return df

    def folders(self, table: str, batch: int | str = "*") -> set[int]:
        """Folders of a table that hold rows of a batch (names only, no file is read)."""
        found = _listed(self.spark, f"{self.path(table)}/folder=*/batch={batch}")
        return {int(p.getParent().getName().split("=", 1)[1]) for p in found}

    def write(self, table: str, df: DataFrame, batch: int) -> None:
        """One file for each bucket and folder; the batch's rows of before are replaced."""
        schema, key = TABLES[table]
        folder = incremental.day_of("id") if key == "id" else incremental.folder_of(key, "ts")
        rows = df.select(*schema.names, folder.alias("folder"), F.lit(batch).cast("long").alias("batch"))
        rows.repartition(self.buckets, "api_key", "site", key).write.mode("overwrite").insertInto(self.name(table))


def _listed(spark: SparkSession, pattern: str) -> list:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    return [x.getPath() for x in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p) or ()]


def open_store(spark: SparkSession, root: str, buckets: int | None = None) -> Store:
    """The store below ``root``, made with a number of buckets the first time. Its tables are
    entered in the session's catalog again if they aren't there, with the batches of other writers."""
    root = root.rstrip("/")
    kept = incremental.subfolders(spark, root, "buckets")
    if kept and buckets not in (None, int(kept[0])):
        raise ValueError(f"the store below {root} has {kept[0]} buckets, not {buckets}")
    if not kept:
        if buckets is None:
            raise ValueError(f"no store below {root}; name a number of buckets")
        for folder in (*TABLES, f"buckets={buckets}"):
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{folder}")
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)
    store = Store(spark, root, buckets or int(kept[0]))
    for table, (schema, key) in TABLES.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {store.name(table)} ({columns}, folder BIGINT, batch BIGINT) USING parquet OPTIONS (partitionOverwriteMode 'dynamic') "
                  f"PARTITIONED BY (folder, batch) CLUSTERED BY (api_key, site, {key}) INTO {store.buckets} BUCKETS LOCATION '{store.path(table)}'")
        spark.sql(f"MSCK REPAIR TABLE {store.name(table)}")
    return store


def write_model(model, store: Store, batch: int, hot_rows: int = HOT_ROWS) -> None:
    """A batch's typed tables by joining id, and what it adds to the facts, which lie
    below ``<root>/<fact>/batch=<id>`` as :func:`webmetrics.sources.sinks.write_model` has them
    (``sinks.read_table`` and ``sinks.compact`` work on them). ``hot_rows`` changes where rows lie,
    never which there are."""
    write_typed(model, store, batch, hot_rows)
    write_facts(store, batch)


def write_typed(model, store: Store, batch: int, hot_rows: int = HOT_ROWS) -> None:
    """A batch's typed tables, and the sessions whose visitor it makes known."""
    store.write("visitor_event", model.visitor, batch)
    store.write("session_event", model.session, batch)
    # its rows, enriched, once more by visitor
    _write_children(store, "session_by_visitor", store.read("session_event", batch=batch), batch, hot_rows)
    _write_children(store, "section_event", model.section, batch, hot_rows)
    store.write("session_known", known(store, batch), batch)


def write_facts(store: Store, batch: int) -> None:
    """What a batch adds to the facts."""
    sinks.write_table(section_combined(store, batch), f"{store.root}/section_combined/batch={batch}", "section_combined", "overwrite")
    sinks.write_table(hierarchy(store, batch), f"{store.root}/hierarchy_event/batch={batch}", "hierarchy_event", "overwrite")
    visitors = store.read("visitor_event", batch=batch).drop("folder", "batch")
    sinks.write_table(rollup.visitor_timeseries(visitors), f"{store.root}/visitor_timeseries/batch={batch}", "visitor_timeseries", "overwrite")


def _write_children(store: Store, table: str, rows: DataFrame, batch: int, hot_rows: int) -> None:
    """Children by parent; those of hot parents apart, with a list of these parents."""
    key, schema = list(incremental.KEY), TABLES[table][0]
    many = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows).select(*key)
    many.write.mode("overwrite").parquet(f"{store.path(table)}_hot_ids/batch={batch}")
    listed = store.spark.read.schema(many.schema).parquet(f"{store.path(table)}_hot_ids/batch={batch}")
    if listed.isEmpty():
        hot, usual = rows.where(F.lit(False)), rows
    else:
        hot = rows.join(checked_broadcast(listed), key, "left_semi")
        usual = rows.join(checked_broadcast(listed), key, "left_anti")
    store.write(table, usual, batch)
    hot.select(*schema.names).write.mode("overwrite").parquet(f"{store.path(table)}_hot/batch={batch}")


def _batches(store: Store, table: str, schema: T.StructType) -> DataFrame:
    """A table of batches that is not bucketed."""
    return store.spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(store.path(table))


def _met(store: Store, children: str, parents: str, batch: int | None, columns: dict[str, str], carried: list[str]) -> DataFrame:
    """The pairs of child and parent that a batch adds: its children with all parents so far, and
    earlier children with its parents; None: the pairs of all batches by one join. ``columns``:
    what the parent gives, by its name there; ``carried``: what the child gives."""
    key = list(incremental.KEY)
    schema = TABLES[children][0]
    ids = T.StructType([schema[c] for c in key])

    def pairs(child, parent, hint=lambda df: df):
        parent = parent.select("api_key", "site", F.col("id").alias("parent"), *[F.col(c).alias(n) for c, n in columns.items()])
        return child.select(*key, *carried).join(hint(parent), key)

    def hot_pairs(which, parent):
        """Children of hot parents (``which``: their batches), by the few parents they have."""
        listed = _batches(store, f"{children}_hot_ids", ids).where(which).distinct()
        if listed.isEmpty():
            return []
        days = incremental.days_named(listed, incremental.day_of("parent"), store.folders(parents))
        few = parent.where(F.col("folder").isin(days)).join(checked_broadcast(listed.withColumnRenamed("parent", "id")), ["api_key", "site", "id"], "left_semi")
        return [pairs(_batches(store, f"{children}_hot", schema).where(which), few, checked_broadcast)]

    if batch is None:
        parts = [pairs(store.read(children), store.read(parents)), *hot_pairs(F.lit(True), store.read(parents))]
    else:
        stored, mine, here = store.folders(parents), store.folders(parents, batch), store.folders(children, batch)
        days = here & stored
        if any(f < 0 for f in here):      # parents far from their children: the days are in the ids
            far = store.read(children, [f for f in here if f < 0], batch)
            days |= set(incremental.days_named(far, incremental.day_of("parent"), stored))
        upto, own = F.col("batch") <= batch, F.col("batch") == batch
        parts = [pairs(store.read(children, here, batch), store.read(parents, days).where(upto)), *hot_pairs(own, store.read(parents).where(upto))]
        earlier = store.folders(children) & incremental.folders_of_days(mine)
        if earlier:
            parts.append(pairs(store.read(children, earlier, batch, before=True), store.read(parents, mine, batch)))
        parts += hot_pairs(F.col("batch") < batch, store.read(parents, mine, batch))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def known(store: Store, batch: int) -> DataFrame:
    """Sessions whose visitor exists, as far as a batch adds them."""
    return _met(store, "session_by_visitor", "visitor_event", batch, {}, ["id"]).select("api_key", "site", "id", F.col("parent").alias("visitor"))


def section_combined(store: Store, batch: int | None = None) -> DataFrame:
    """Rows that a batch adds, or those of one co-located join over all batches."""
    attributes = {c: c for c in ("os", "browser", "country_code", "city")} | {"parent": "visitor"}
    rows = _met(store, "section_event", "session_event", batch, attributes, ["ts", "path"])
    return rows.withColumn("ts", bucket5("ts")).select(*rollup.FACT_COLS)


def hierarchy(store: Store, batch: int | None = None) -> DataFrame:
    """Rows that a batch adds, or those of one co-located join over all batches."""
    rows = _met(store, "section_event", "session_known", batch, {"visitor": "visitor"}, ["id", "ts"])
    return rows.select("api_key", "site", "visitor", F.col("parent").alias("session"), F.col("id").alias("section"), "ts")
