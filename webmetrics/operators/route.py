"""Routing of the generic event hub into typed tables.

Each route is a filter plus a key-membership semi join. The event-type
predicate is pushed into every branch of a union-built hub, so branches of
other types are pruned at plan time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webmetrics.functions.ids import is_uuid, uuid_norm
from webmetrics.functions.url import url_part
from webmetrics.plans.strategy import checked_broadcast


def _attr(k: str):
    return F.col("attrs").getItem(k)


def known(df: DataFrame, sources_df: DataFrame) -> DataFrame:
    """Keep rows whose (api_key, site) is an allowed source (left semi).

    The source list is broadcast when its size is proven bounded, else the
    semi join shuffles on (api_key, site) of the *distinct* sources side and
    AQE handles skew of the event side.
    """
    return df.join(checked_broadcast(sources_df.select("api_key", "site")),
                   ["api_key", "site"], "left_semi")


def visitors(event: DataFrame, sources_df: DataFrame) -> DataFrame:
    """VISITOR_EVENT rows."""
    v = event.where(F.col("event_type") == "Visitor")
    return known(v, sources_df).select("api_key", "site", "id", "ts", "attrs")


def _with_parent(df: DataFrame) -> DataFrame:
    # Parent > '' (NULL fails too); D13: the parent must parse as a
    # UUID (the reference's cast would reject the row) and is stored in
    # canonical lower-case hyphenated form.
    p = F.trim(_attr("parent"))
    return (df.where((_attr("parent") > "") & is_uuid(p))
              .withColumn("parent", uuid_norm(p)))


def _taken(df: DataFrame, *names: str) -> DataFrame:
    """Attributes as columns, so that the key join below does not carry the map for them."""
    return df.withColumns({f"_{a}": _attr(a) for a in names})


def sessions(event: DataFrame, sources_df: DataFrame) -> DataFrame:
    """C2 + D12: SESSION_EVENT rows before enrichment (parent, user_agent, ipv4, ipv6)."""
    s = _taken(_with_parent(event.where(F.col("event_type") == "Session")), "user_agent", "ipv4", "ipv6")
    return known(s, sources_df).select(
        "api_key", "site", "id", "ts", "parent",
        F.coalesce("_user_agent", F.lit("")).alias("user_agent"),
        F.col("_ipv4").alias("ipv4"), F.col("_ipv6").alias("ipv6"), "attrs")


def sections(event: DataFrame, sources_df: DataFrame) -> DataFrame:
    """C3 + D10/D11: SECTION_EVENT rows with path, query, fragment, title."""
    s = _taken(_with_parent(event.where(F.col("event_type") == "Section")), "location", "title")
    loc = F.col("_location")
    return known(s, sources_df).select(
        "api_key", "site", "id", "ts", "parent",
        url_part(loc, "PATH").alias("path"), url_part(loc, "QUERY").alias("query"),
        url_part(loc, "REF").alias("fragment"),
        F.coalesce("_title", F.lit("")).alias("title"), "attrs")


def clicks(event: DataFrame) -> DataFrame:
    """C4: clicks are accepted by ingest but feed no table; exposed as a filter."""
    return event.where(F.col("event_type") == "Click").select(
        "api_key", "site", "id", "ts", F.coalesce(_attr("parent"), F.lit("")).alias("parent"))
