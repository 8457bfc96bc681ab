"""Dimensions and lookup sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webmetrics import schema as S
from webmetrics.sources.catalogue import UA_RULES


def api_key_latest(df: DataFrame, seq_col: str = "seq") -> DataFrame:
    """Last row per (api_key, site) wins (replacing-key semantics).

    Partitioned by the full key, so the window never gathers more than one
    key's versions in a frame; ties on ``seq`` break on customer for
    determinism.
    """
    w = Window.partitionBy("api_key", "site").orderBy(F.col(seq_col).desc(), F.col("customer").desc())
    return (df.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") == 1).drop("_rn"))


def sources(api_key_df: DataFrame) -> DataFrame:
    """Allowed (api_key, site) pairs, trimmed, non-empty, distinct."""
    return (api_key_df
            .select(F.trim("api_key").alias("api_key"), F.trim("site").alias("site"))
            .where((F.length("api_key") > 0) & (F.length("site") > 0))
            .distinct())


def key_versions(changes: DataFrame) -> DataFrame:
    """K8: (api_key, site, valid_from, valid_to) of a key's active times, from its changes
    (api_key, site, seq, valid_from, active). A change holds until the key's next one
    (null: still); of changes at one time the largest ``seq`` counts, the others last no time."""
    c = changes.select(F.trim("api_key").alias("api_key"), F.trim("site").alias("site"), "seq", "valid_from", "active")
    c = c.where((F.length("api_key") > 0) & (F.length("site") > 0) & F.col("valid_from").isNotNull())
    w = Window.partitionBy("api_key", "site").orderBy("valid_from", "seq", "active")
    c = c.withColumn("valid_to", F.lead("valid_from").over(w))
    return c.where(F.col("active") & (F.col("valid_to").isNull() | (F.col("valid_from") < F.col("valid_to")))).drop("seq", "active")


def read_iso_csv(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """A10: ISO-3166 country table (11 nullable text columns)."""
    return spark.read.schema(S.ISO_COUNTRY).option("header", header).csv(path)


def read_ip_range_csv(spark: SparkSession, path: str) -> DataFrame:
    """IP-range geolocation table; ``.csv.gz`` is decompressed by the reader."""
    return spark.read.schema(S.IP_RANGE).option("header", False).csv(path)


def ua_rules_df(spark: SparkSession, rules=None) -> DataFrame:
    """Rule table (kind, priority, regex, repl) from in-code rules."""
    rows = [(k, p, r, dict(m)) for k, p, r, m in (rules or UA_RULES)]
    return spark.createDataFrame(rows, S.UA_RULE)


def read_ua_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rule table from JSON lines ``{kind, priority, regex, repl}``."""
    return spark.read.schema(S.UA_RULE).json(path)
