"""Ingest validation (A1, B1-B15): request envelopes -> events, quarantine, summary.

A request is all-or-nothing. Every check is an expression on the request
row, evaluated over the event *array* (``transform`` / ``filter`` /
``exists``) before anything is exploded, so the decision needs no shuffle.
The first failing check wins, in the order of the reference:

  headers (origin host, api-key, user agent)          -> 400
  body decoding (type 1..4, id is a UUID) for all     -> 400 InvalidRequestBody
  per event, in array order: parent attr 'p' is a UUID (types 2-4),
    api key non-blank, site non-blank, id version 7,
    now-1h < ts < now+5min (now = received_at)        -> 400
  empty event array                                   -> 500 InvalidRequest
  (api_key, site) not an allowed source               -> 500 UnknownSource
  otherwise                                           -> 201, all events saved
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webmetrics import schema as S
from webmetrics.functions.ids import is_uuid, uuid7_ts, uuid_norm, uuid_version
from webmetrics.functions.url import url_host
from webmetrics.plans.strategy import checked_broadcast

STATUS = {"InvalidRequestHeaders": 400, "ApiKey": 400, "InvalidRequestBody": 400, "Site": 400,
          "UuidVersion": 400, "TimestampOutOfRange": 400, "InvalidRequest": 500,
          "UnknownSource": 500}


@dataclass
class IngestResult:
    events: DataFrame       # EVENT rows of accepted requests (+ request_id)
    quarantine: DataFrame   # one row per event of refused requests (+ reason, status)
    summary: DataFrame      # one row per request: status, reason, event_count
    checked: DataFrame      # request rows with site, reason, status (internal)


def read_requests(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """A1: request envelopes from JSON lines (batch or stream) with a fixed schema."""
    r = spark.readStream if streaming else spark.read
    return r.schema(S.REQUEST).json(path)


def parse_request_json(df: DataFrame, col: str = "value") -> DataFrame:
    """A1 for message sources (e.g. Kafka ``value``): JSON text -> REQUEST columns."""
    return df.select(F.from_json(F.col(col).cast("string"), S.REQUEST).alias("r")).select("r.*")


def _type(e) -> Column:
    return F.coalesce(e["t"], e["event_type"])


def _id(e) -> Column:
    return F.coalesce(e["i"], e["id"])


def _attrs(e) -> Column:
    return F.coalesce(e["a"], e["attrs"])


def _body_ok(e) -> Column:
    t = _type(e)
    return F.coalesce(t.between(1, 4), F.lit(False)) & is_uuid(_id(e))


def _event_error(e, api_key: Column, site: Column, received: Column) -> Column:
    t, i = _type(e), _id(e)
    p = _attrs(e)["p"]
    ts = uuid7_ts(i)
    lo = received - F.expr(f"INTERVAL {S.MAX_BEFORE_SECONDS} SECONDS")
    hi = received + F.expr(f"INTERVAL {S.MAX_AFTER_SECONDS} SECONDS")
    return (F.when(t.isin(2, 3, 4) & ~is_uuid(p), F.lit("InvalidRequestBody"))
             .when(F.length(F.trim(api_key)) == 0, F.lit("ApiKey"))
             .when(F.length(F.trim(site)) == 0, F.lit("Site"))
             .when(uuid_version(i) != 7, F.lit("UuidVersion"))
             .when(~F.coalesce((ts > lo) & (ts < hi), F.lit(False)), F.lit("TimestampOutOfRange")))


def check(requests: DataFrame, sources_df: DataFrame) -> DataFrame:
    """Request rows + ``site``, ``reason`` (NULL when accepted) and ``status``. Sources with
    ``valid_from`` and ``valid_to`` (:func:`dims.key_versions`) are looked up as of the receipt."""
    site = url_host(F.col("origin"))
    r = requests.withColumn("site", site)
    header = (F.when(F.col("site").isNull(), F.lit("InvalidRequestHeaders"))
               .when(F.col("api_key").isNull(), F.lit("ApiKey"))
               .when(F.col("user_agent").isNull(), F.lit("InvalidRequestHeaders")))
    evs = F.col("events")
    body = F.when(evs.isNull() | F.exists(evs, lambda e: ~_body_ok(e)), F.lit("InvalidRequestBody"))
    errs = F.filter(F.transform(evs, lambda e: _event_error(e, F.col("api_key"), F.col("site"),
                                                            F.col("received_at"))),
                    lambda x: x.isNotNull())
    first = F.try_element_at(errs, F.lit(1))
    empty = F.when(F.size(evs) == 0, F.lit("InvalidRequest"))
    times = [c for c in ("valid_from", "valid_to") if c in sources_df.columns]
    src = checked_broadcast(sources_df.select(F.col("api_key").alias("_k"), F.col("site").alias("_s"), *times,
                                              F.lit(True).alias("_known")))
    same = (F.trim(r.api_key) == src._k) & (F.trim(r.site) == src._s)
    if times:
        same &= (r.received_at >= src.valid_from) & (src.valid_to.isNull() | (r.received_at < src.valid_to))
    r = r.join(src, same, "left").drop(*times)
    unknown = F.when(F.col("_known").isNull(), F.lit("UnknownSource"))
    reason = F.coalesce(header, body, first, empty, unknown)
    status_map = F.create_map(*[x for k, v in STATUS.items() for x in (F.lit(k), F.lit(v))])
    return (r.withColumn("reason", reason).drop("_k", "_s", "_known")
             .withColumn("status", F.coalesce(F.try_element_at(status_map, F.col("reason")), F.lit(201))))


def _normalised_attrs(t: Column, a: Column, ua: Column, ip: Column) -> Column:
    """Keep and rename the attributes of each type, drop all others."""
    parent = uuid_norm(a["p"])
    ip_key = F.when(ip.contains(":"), F.lit("ipv6")).otherwise(F.lit("ipv4"))
    m = (F.when(t == 2, F.create_map(F.lit("parent"), parent, F.lit("user_agent"), ua, ip_key, ip))
          .when(t == 3, F.create_map(F.lit("parent"), parent, F.lit("location"), a["l"],
                                     F.lit("title"), a["t"]))
          .when(t == 4, F.create_map(F.lit("parent"), parent))
          .otherwise(F.create_map().cast("map<string,string>")))
    return F.map_filter(m, lambda _k, v: v.isNotNull())


def validate(requests: DataFrame, sources_df: DataFrame) -> IngestResult:
    """B1-B15 over request envelopes; see the module doc for the check order."""
    c = check(requests, sources_df)
    ok = c.where(F.col("reason").isNull())
    x = ok.select("request_id", F.trim("api_key").alias("api_key"), F.trim("site").alias("site"),
                  "user_agent", "ip", F.posexplode("events").alias("pos", "e"))
    t = _type(F.col("e"))
    type_map = F.create_map(*[y for k, v in S.TYPE_MAP.items() for y in (F.lit(k), F.lit(v))])
    events = x.select(
        "request_id", "pos", "api_key", "site", F.try_element_at(type_map, t).alias("event_type"),
        uuid_norm(_id(F.col("e"))).alias("id"), uuid7_ts(_id(F.col("e"))).alias("ts"),
        _normalised_attrs(t, _attrs(F.col("e")), F.col("user_agent"), F.col("ip")).alias("attrs"))
    bad = c.where(F.col("reason").isNotNull())
    quarantine = bad.select("request_id", "received_at", "origin", "api_key", "user_agent", "ip",
                            "reason", "status", F.posexplode_outer("events").alias("pos", "e"))
    summary = c.select("request_id", "status", "reason",
                       F.when(F.col("reason").isNull(), F.size("events")).otherwise(F.lit(0))
                        .cast("long").alias("event_count"))
    return IngestResult(events=events, quarantine=quarantine, summary=summary, checked=c)


def hub(result: IngestResult) -> DataFrame:
    """A2: accepted events in the generic EVENT layout."""
    return result.events.select("api_key", "site", "event_type", "id", "ts", "attrs")
