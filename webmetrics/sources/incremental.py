"""Joins kept up to date batch by batch.

An inner join of children (page views) with parents (sessions) over all batches is the sum of
what each batch adds: its children with the parents known by then, and earlier children with its
parents. Earlier children that have met a parent are done, unless that parent comes
again. So each batch writes its children to a *link table*, marked as pending (no parent yet)
or not, below the day that the parent's id names:

    <link>/pending=<0|1>/folder=<day>/batch=<id>

Ids are version 7 UUIDs, so a parent that comes now can only be missed by pending children
below its own day, and a child's parent can only be stored on the day that its id names. A
batch therefore reads the stored parents and the pending children of the days it names,
and matched children only of the days of parents that came before. What it reads does not
grow with the history.

Ids of other versions name any day. Children whose parent's day is more than
``NEAR_DAYS`` from their own are kept in one folder per century (below 0), so garbage makes no
folders of its own; a batch reads the folder of its parents' centuries as well.

A batch that is written again replaces its own rows and yields the same ones: it reads
earlier batches only. Repeated children and repeated parents each count, as in a join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webmetrics.functions.ids import uuid7_millis

KEY = ("api_key", "site", "parent")
NEAR_DAYS = 31
_CENTURY = 36525
_DAY_MS = 86_400_000


def day_of(c: str) -> Column:
    """Day number (since 1970) that an id names; -1 without one."""
    return F.coalesce(F.floor(uuid7_millis(c) / _DAY_MS), F.lit(-1)).cast("long")


def folder_of(parent: str, ts: str) -> Column:
    """Folder of a child: its parent's day, or the century of a day far from its own."""
    return _folder(day_of(parent), ts)


def _folder(day: Column, ts: str) -> Column:
    near = F.abs(day - F.floor(F.unix_millis(ts) / _DAY_MS)) <= NEAR_DAYS
    return F.when(near & (day >= 0), day).otherwise(-1 - F.floor(F.greatest(day, F.lit(0)) / _CENTURY)).cast("long")


def folders_of_days(days) -> set[int]:
    """Where children of parents of these days are: their day and their century."""
    return set(days) | {-1 - max(d, 0) // _CENTURY for d in days}


def subfolders(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of ``column=<value>`` folders directly below a path, which may hold wildcards."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/{column}=*")
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return sorted({x.getPath().getName().split("=", 1)[1] for x in found or ()})


def days_named(df: DataFrame, day: Column, among) -> list[int]:
    """The distinct days of the rows, out of those that exist (so a bounded list)."""
    among = sorted(among)
    if not among:
        return []
    return [r[0] for r in df.select(day.alias("d")).where(F.col("d").isin(among)).distinct().collect()]


def read_links(spark: SparkSession, path: str, schema: T.StructType, pending: int, folders, batch: int) -> DataFrame | None:
    """Children of earlier batches below the given folders; None if there is none."""
    here = {int(v) for v in subfolders(spark, f"{path}/pending={pending}", "folder")} & set(folders)
    here = {f for f in here if any(int(b) < batch for b in subfolders(spark, f"{path}/pending={pending}/folder={f}", "batch"))}
    if not here:
        return None
    full = T.StructType([*schema.fields, T.StructField("folder", T.LongType()), T.StructField("batch", T.LongType())])
    base = f"{path}/pending={pending}"
    rows = spark.read.schema(full).option("basePath", base).parquet(*[f"{base}/folder={f}" for f in sorted(here)])
    return rows.where(F.col("batch") < batch).drop("folder", "batch")


def added(spark: SparkSession, path: str, batch: int, children: DataFrame, parents: DataFrame, stored_days: set[int],
          stored: Callable[[list[int]], DataFrame]) -> DataFrame:
    """The rows that a batch adds to children JOIN parents, and writes its children.

    ``children`` have api_key, site, parent and ts, ``parents`` api_key, site and their own id
    as parent; no other names are shared. ``stored(days)`` gives the earlier batches' parents
    of some days out of ``stored_days``.
    """
    child_days = days_named(children, day_of("parent"), stored_days)
    folders = {int(v) for p in (0, 1) for v in subfolders(spark, f"{path}/pending={p}", "folder")}
    asked = set(stored_days) | {f for f in folders if f >= 0}
    if any(f < 0 for f in folders):      # a century's folder may hold children of any day
        parent_days = [r[0] for r in parents.select(day_of("parent").alias("d")).distinct().collect()]
    else:
        parent_days = days_named(parents, day_of("parent"), asked)
    days = sorted((set(child_days) | set(parent_days)) & set(stored_days))
    older = stored(days) if days else None
    known = parents if older is None else parents.unionByName(older)

    met = known.select(*KEY).distinct().withColumn("met", F.lit(True))
    marked = children.join(met, list(KEY), "left")
    pending = F.when(F.col("met"), 0).otherwise(1)
    marked = marked.withColumn("_day", day_of("parent"))       # parsed once a row
    out = marked.select(*children.columns, pending.alias("pending"), _folder(F.col("_day"), "ts").alias("folder"), F.lit(batch).cast("long").alias("batch"))
    (out.hint("rebalance", "pending", "folder").write.partitionBy("pending", "folder", "batch").mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").parquet(path))

    rows = children.join(known, list(KEY))
    waiting = read_links(spark, path, children.schema, 1, folders_of_days(parent_days), batch)
    if waiting is not None:
        rows = rows.unionByName(waiting.join(parents, list(KEY)).select(rows.columns))
    if older is not None:
        again = parents.join(older.select(*KEY).distinct(), list(KEY), "left_semi")
        done = read_links(spark, path, children.schema, 0, folders_of_days(days_named(again, day_of("parent"), days)), batch)
        if done is not None:
            rows = rows.unionByName(done.join(again, list(KEY)).select(rows.columns))
    return rows


def expire_links(spark: SparkSession, path: str, as_of_ms: int, late_ms: int = 65 * 60_000) -> list[str]:
    """Deletes the folders of days whose parents can't come any more: an event is refused when its
    id is older than an hour, so a day is over ``late_ms`` after its end. For a source
    that is read in order of receipt; later backfills of old parents find no children."""
    jvm = spark.sparkContext._jvm
    gone = []
    for pending in (0, 1):
        for v in subfolders(spark, f"{path}/pending={pending}", "folder"):
            if int(v) >= 0 and (int(v) + 1) * _DAY_MS + late_ms <= as_of_ms:
                p = jvm.org.apache.hadoop.fs.Path(f"{path}/pending={pending}/folder={v}")
                p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
                gone.append(str(p))
    return gone
