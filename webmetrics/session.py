"""Spark session helpers: UTC time zone, AQE, zstd Parquet, checkpoint dir."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Session settings every job relies on. Time semantics assume UTC
# (5-minute / hour / day buckets are UTC buckets).
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # Broadcast only behind a proven bound: no planning-time broadcast from
    # *estimated* statistics (they under-count e.g. after explode). Joins are
    # broadcast by the explicit bounded checks (plans/strategy.py) or by AQE
    # from the *measured* size of a finished shuffle stage.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
}


# Partition sizing for cluster runs (applied only where the cluster has not
# set its own value): many initial shuffle partitions that AQE coalesces to
# ~256 MB tasks, so a 100 TB shuffle does not spill from oversized tasks and
# a small one does not run thousands of empty tasks.
SCALE_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def configure(spark: SparkSession, scale: bool = False) -> SparkSession:
    """Apply the runtime SQL settings to an existing session.

    ``scale=True`` also applies SCALE_CONF for keys the session leaves unset.
    """
    for k, v in SESSION_CONF.items():
        spark.conf.set(k, v)
    if scale:
        launched = spark.sparkContext.getConf()
        for k, v in SCALE_CONF.items():
            if not launched.contains(k):  # keep what the cluster launch set
                spark.conf.set(k, v)
    return spark


def get_spark(master: str | None = None, app: str = "webmetrics",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings of SESSION_CONF.

    On a cluster ``master`` stays None and the launcher decides; locally
    (tests, bench) pass e.g. ``local[8]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
        b = b.config("spark.ui.enabled", "false")
        b = b.config("spark.driver.memory", os.environ.get("WEBMETRICS_DRIVER_MEM", "8g"))
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark, scale=master is None)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Only when it is unset under a local master (tests) a private temporary folder is
    created and registered; a cluster must name one.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="webmetrics-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # core conf not settable at runtime on this session
            pass
    try:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(d)
    except Exception:  # pragma: no cover - Connect sessions have no context
        pass
    return d
