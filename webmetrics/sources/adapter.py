"""Driver tables -> our event model (test-data adapter).

Only ``events`` (and ``nation`` / ``region`` for the lookup dimensions) are
used. Every derived column is a plain Spark expression with a direct DuckDB
twin in :mod:`webmetrics.plans.oracle`.

Definitions (per driver event row):
  k      = int(props.k), ms = floor(epoch millis), day = ms div 86 400 000
  tenant = user_id % 4 -> api_key 'key-t', site 'site<t>.example.com';
           the key dimension holds t = 0, 1, 2 only (t = 3 is unknown)
  visitor  one per user,       id uuid7(min ms, 1, user_id)
  session  one per user-day,   id uuid7(min ms of day, 2, user_id), parent visitor
  section  view / purchase,    id uuid7(ms, 3, event_id), parent the user-day
           session; k = 0 -> a parent that does not exist, k = 1 -> ''
  click    click,              id uuid7(ms, 4, event_id), parent the session
  session user agent = USER_AGENTS[(user_id + day) % 10],
  session ipv4 = 10.((user_id div 4) % 8).(day % 4).(user_id % 250)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webmetrics.functions.ids import uuid7, uuid7_ts
from webmetrics.sources.catalogue import USER_AGENTS

DAY_MS = 86_400_000
SECTION_TYPES = ("view", "purchase")


_READ: dict = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table of the driver; the relation (file listing) is reused per session."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _READ:
        _READ[key] = spark.read.parquet(path)
    return _READ[key]


def api_key_of(t) -> Column:
    return F.concat(F.lit("key-"), t.cast("string"))


def site_of(t) -> Column:
    return F.concat(F.lit("site"), t.cast("string"), F.lit(".example.com"))


def base_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver events with the derived ``ms``, ``k``, ``day`` and tenant ``t``."""
    e = read(spark, sf_dir, "events")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return e.select(
        "event_id", "user_id", "event_type", ms.alias("ms"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.pmod("user_id", F.lit(4)).alias("t"),
    ).withColumn("day", F.expr(f"ms div {DAY_MS}"))


def user_agent_of(user_id, day) -> Column:
    idx = F.pmod(F.col(user_id) + F.col(day), F.lit(len(USER_AGENTS)))
    return F.element_at(F.array(*[F.lit(u) for u in USER_AGENTS]), (idx + 1).cast("int"))


def ipv4_of(user_id, day) -> Column:
    u, d = F.col(user_id), F.col(day)
    return F.concat_ws(".", F.lit("10"), F.pmod(F.floor(u / F.lit(4)), F.lit(8)).cast("string"),
                       F.pmod(d, F.lit(4)).cast("string"),
                       F.pmod(u, F.lit(250)).cast("string"))


def location_of(site: Column, k: Column) -> Column:
    return F.concat(F.lit("https://"), site, path_of(k), F.lit("?k="), k.cast("string"),
                    F.lit("#s"), F.pmod(k, F.lit(3)).cast("string"))


def path_of(k: Column) -> Column:
    return F.concat(F.lit("/dir"), F.pmod(k, F.lit(6)).cast("string"),
                    F.lit("/type"), F.pmod(k, F.lit(5)).cast("string"))


def user_days(ev: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sessions per user-day with first ms, visitors per user with first ms).

    Both are aggregations with map-side partial aggregation, so a user holding
    a large share of all rows does not overload one task.
    """
    # The first event is the least (ms, event_id). Packed into one decimal
    # key, so the minimum runs as a hash aggregate with partial aggregation.
    key = (F.col("ms").cast("decimal(38,0)") * F.lit(_PACK).cast("decimal(38,0)")
           + F.col("event_id").cast("decimal(38,0)")).cast("decimal(38,0)")
    sd = ev.groupBy("user_id", "day").agg(F.min(key).alias("f"))
    sd = sd.select("user_id", "day", *_unpack("f", "sms", "s_eid"))
    vd = sd.groupBy("user_id").agg(F.min(
        (F.col("sms").cast("decimal(38,0)") * F.lit(_PACK).cast("decimal(38,0)")
         + F.col("s_eid").cast("decimal(38,0)")).cast("decimal(38,0)")).alias("f"))
    vd = vd.select("user_id", *_unpack("f", "vms", "v_eid"))
    return sd, vd


_PACK = 10 ** 18  # event ids stay below 10^18; ms * 10^18 fits decimal(38)


def _unpack(c: str, hi: str, lo: str):
    k = F.col(c)
    p = F.lit(_PACK).cast("decimal(38,0)")
    return [F.floor(k / p).cast("long").alias(hi), F.pmod(k, p).cast("long").alias(lo)]


def event_hub(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: the generic event DataFrame (api_key, site, event_type, id, ts, attrs)."""
    ev = base_events(spark, sf_dir)
    sd, vd = user_days(ev)
    t = F.pmod("user_id", F.lit(4))
    empty = F.create_map().cast("map<string,string>")

    vid = uuid7(F.col("vms"), F.lit(1), F.col("user_id"))
    visitors = vd.select(
        api_key_of(t).alias("api_key"), site_of(t).alias("site"),
        F.lit("Visitor").alias("event_type"), vid.alias("id"),
        uuid7_ts(vid).alias("ts"), empty.alias("attrs"))

    sid = uuid7(F.col("sms"), F.lit(2), F.col("user_id"))
    sessions = sd.join(vd, "user_id").select(
        api_key_of(t).alias("api_key"), site_of(t).alias("site"),
        F.lit("Session").alias("event_type"), sid.alias("id"),
        uuid7_ts(sid).alias("ts"),
        F.create_map(F.lit("parent"), vid, F.lit("user_agent"), user_agent_of("user_id", "day"),
                     F.lit("ipv4"), ipv4_of("user_id", "day")).alias("attrs"))

    kids = (ev.where(F.col("event_type").isin(*SECTION_TYPES, "click"))
              .join(sd, ["user_id", "day"]))
    k = F.col("k")
    is_section = F.col("event_type").isin(*SECTION_TYPES)
    own = uuid7(F.col("ms"), F.when(is_section, F.lit(3)).otherwise(F.lit(4)), F.col("event_id"))
    sess_id = uuid7(F.col("sms"), F.lit(2), F.col("user_id"))
    parent = (F.when(is_section & (k == 0), uuid7(F.col("ms"), F.lit(5), F.col("event_id")))
               .when(is_section & (k == 1), F.lit(""))
               .otherwise(sess_id))
    site = site_of(t)
    attrs = F.when(is_section, F.create_map(
        F.lit("parent"), parent, F.lit("location"), location_of(site, k),
        F.lit("title"), F.concat(path_of(k), F.lit(" | Demo")))
    ).otherwise(F.create_map(F.lit("parent"), parent))
    children = kids.select(
        api_key_of(t).alias("api_key"), site.alias("site"),
        F.when(is_section, F.lit("Section")).otherwise(F.lit("Click")).alias("event_type"),
        own.alias("id"), uuid7_ts(own).alias("ts"), attrs.alias("attrs"))
    return visitors.unionByName(sessions).unionByName(children)


def api_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API_KEY dimension rows for tenants 0..2, two versions each (seq 1, 2).

    Derived from the tenants present in ``events``; version 2 is the current
    customer name, so A9 must return the ``v2`` rows.
    """
    ev = read(spark, sf_dir, "events")
    ts = (ev.select(F.pmod("user_id", F.lit(4)).alias("t")).distinct()
            .where(F.col("t") < 3))
    v = F.explode(F.array(F.lit(1), F.lit(2))).alias("seq")
    return ts.select("t", v).select(
        api_key_of(F.col("t")).alias("api_key"), site_of(F.col("t")).alias("site"),
        F.concat(F.lit("customer-"), F.col("t").cast("string"), F.lit("-v"),
                 F.col("seq").cast("string")).alias("customer"),
        F.col("seq").cast("long").alias("seq"))


def iso_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO-3166-like table from ``nation``: cca2 'N'+letter, cca3 'NA'+letter.

    Nation 24 is left out so its ranges resolve to country ''.
    """
    n = read(spark, sf_dir, "nation").where(F.col("n_nationkey") != 24)
    letter = F.expr("chr(65 + n_nationkey)")
    nul = F.lit(None).cast("string")
    return n.select(
        F.col("n_name").alias("name"), F.concat(F.lit("N"), letter).alias("cca2"),
        F.concat(F.lit("NA"), letter).alias("cca3"),
        F.col("n_nationkey").cast("string").alias("ccn"), nul.alias("iso_3166_2"),
        F.col("n_regionkey").cast("string").alias("region"), nul.alias("sub_region"),
        nul.alias("intermediate_region"), F.col("n_regionkey").cast("string").alias("region_code"),
        nul.alias("sub_region_code"), nul.alias("intermediate_region_code"))


def ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IP-range table derived from ``nation`` x ``region``.

    For a in 0..6 and b in 0..2: 10.a.b.0-10.a.b.255 -> nation (4a + b) % 25,
    city '<nation>/<b>', state = region name.  For a in 0..6:
    10.a.0.0-10.a.255.255 -> nation a with blank city and NULL state.
    10.7.x.x has no range (-> 'unknown').  Two extra ranges outside 10/8: a
    two-address block and an unaligned block (exercise quirk Q4).
    """
    n = read(spark, sf_dir, "nation")
    r = read(spark, sf_dir, "region")
    nr = n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        "n_nationkey", "n_name", "r_name")
    a = spark.range(7).select(F.col("id").alias("a"))
    ab = spark.range(21).select((F.col("id") / 3).cast("long").alias("a"),
                                F.pmod("id", F.lit(3)).alias("b"))
    cc = F.concat(F.lit("N"), F.expr("chr(65 + n_nationkey)"))
    nul = F.lit(None).cast("string")

    def _fmt(*parts):
        return F.concat_ws(".", *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts])

    slash24 = (ab.join(nr, F.pmod(F.col("a") * 4 + F.col("b"), F.lit(25)) == F.col("n_nationkey"))
                 .select(_fmt(10, F.col("a").cast("string"), F.col("b").cast("string"), 0).alias("ip_range_start"),
                         _fmt(10, F.col("a").cast("string"), F.col("b").cast("string"), 255).alias("ip_range_end"),
                         cc.alias("country_code"), F.col("r_name").alias("state1"), nul.alias("state2"),
                         F.concat(F.col("n_name"), F.lit("/"), F.col("b").cast("string")).alias("city")))
    slash16 = (a.join(nr, F.col("a") == F.col("n_nationkey"))
                 .select(_fmt(10, F.col("a").cast("string"), 0, 0).alias("ip_range_start"),
                         _fmt(10, F.col("a").cast("string"), 255, 255).alias("ip_range_end"),
                         cc.alias("country_code"), nul.alias("state1"), nul.alias("state2"),
                         F.lit("").alias("city")))
    extra = (nr.where(F.col("n_nationkey").isin(5, 6))
               .select(F.when(F.col("n_nationkey") == 5, F.lit("192.168.0.0")).otherwise(F.lit("172.16.0.5")).alias("ip_range_start"),
                       F.when(F.col("n_nationkey") == 5, F.lit("192.168.0.1")).otherwise(F.lit("172.16.0.20")).alias("ip_range_end"),
                       cc.alias("country_code"), F.col("r_name").alias("state1"), nul.alias("state2"),
                       F.col("n_name").alias("city")))
    out = slash24.unionByName(slash16).unionByName(extra)
    return out.select("*", nul.alias("postcode"), F.lit(0.0).alias("latitude"),
                      F.lit(0.0).alias("longitude"), nul.alias("timezone"))


# --------------------------------------------------------------------------- requests
#
# Ingest-path adapter: driver events grouped into request envelopes of five
# (request_id = event_id div 5). Headers come from the request's first event
# (user u0, k0, day0, tenant t0). The first event of a user also carries that
# user's Visitor body (id uuid7(first ms, 1, user_id)) and the first event of
# a user-day the Session body (id uuid7(first ms of day, 2, user_id), p = the
# visitor), ancestors first. Then every event's own body by type:
#   view/purchase -> Section (3), p = user-day session (k=1: no p, k=2: 'x',
#                    k=0: a session that does not exist); l/t unless k%10 = 3
#   click         -> Click (4),   p = user-day session
#   signup        -> Session (2) of its own, p = the user's visitor
#   error         -> Visitor (1), id version 4 when k even; k%50 = 49 -> type 5,
#                    k%50 = 48 -> id 'not-a-uuid'
#   k%10 = 4 adds an unknown attribute 'zz'; k%10 = 5 uses the long key names.
# Header faults by k0 % 20: 17 no origin, 14 host-less origin, 18 no api key,
# 16 blank api key, 15 padded api key, 19 no user agent, 13 empty event array.
# ip: IPv6 when k0 % 7 = 0. received_at by k0 % 10: 0 -> last event - 10 min,
# 9 -> first event + 61 min, else last event + k0%10 min.


def _body(struct_fields: dict) -> Column:
    return F.struct(*[v.alias(k) for k, v in struct_fields.items()])


def request_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per driver event with its request id and wire body fields."""
    from webmetrics.functions.ids import with_version
    ev = base_events(spark, sf_dir)
    sd, vd = user_days(ev)
    j = ev.join(sd, ["user_id", "day"]).join(vd, "user_id")
    k, et = F.col("k"), F.col("event_type")
    ms, eid, uid = F.col("ms"), F.col("event_id"), F.col("user_id")
    is_sec = et.isin(*SECTION_TYPES)
    typ = (F.when(is_sec, 3).when(et == "click", 4).when(et == "signup", 2)
            .when(F.pmod(k, F.lit(50)) == 49, 5).otherwise(1))
    v1 = uuid7(ms, F.lit(1), eid)
    bid = (F.when(is_sec, uuid7(ms, F.lit(3), eid)).when(et == "click", uuid7(ms, F.lit(4), eid))
            .when(et == "signup", uuid7(ms, F.lit(2), eid))
            .when(F.pmod(k, F.lit(50)) == 48, F.lit("not-a-uuid"))
            .when(F.pmod(k, F.lit(2)) == 0, with_version(v1, "4")).otherwise(v1))
    sess = uuid7(F.col("sms"), F.lit(2), uid)
    vis = uuid7(F.col("vms"), F.lit(1), uid)
    p = (F.when(is_sec & (k == 1), F.lit(None).cast("string"))
          .when(is_sec & (k == 2), F.lit("x"))
          .when(is_sec & (k == 0), uuid7(ms, F.lit(5), eid))
          .when(is_sec | (et == "click"), sess)
          .when(et == "signup", vis))
    t = F.pmod(uid, F.lit(4))
    has_lt = is_sec & (F.pmod(k, F.lit(10)) != 3)
    loc = F.when(has_lt, location_of(site_of(t), k))
    title = F.when(has_lt, F.concat(path_of(k), F.lit(" | Demo")))
    zz = F.when(F.pmod(k, F.lit(10)) == 4, F.lit("junk"))
    attrs = F.map_filter(F.create_map(F.lit("p"), p, F.lit("l"), loc, F.lit("t"), title,
                                      F.lit("zz"), zz), lambda _k, v: v.isNotNull())
    long_names = F.pmod(k, F.lit(10)) == 5
    nul_i, nul_s = F.lit(None).cast("int"), F.lit(None).cast("string")
    nul_m = F.lit(None).cast("map<string,string>")
    body = _body({
        "t": F.when(~long_names, typ).otherwise(nul_i), "i": F.when(~long_names, bid).otherwise(nul_s),
        "a": F.when(~long_names, attrs).otherwise(nul_m),
        "event_type": F.when(long_names, typ).otherwise(nul_i),
        "id": F.when(long_names, bid).otherwise(nul_s), "attrs": F.when(long_names, attrs).otherwise(nul_m)})
    nul_b = F.lit(None).cast(j.select(body.alias("b")).schema["b"].dataType)
    vis_body = _body({"t": F.lit(1), "i": vis, "a": F.create_map().cast("map<string,string>"),
                      "event_type": nul_i, "id": nul_s, "attrs": nul_m})
    ses_body = _body({"t": F.lit(2), "i": sess, "a": F.create_map(F.lit("p"), vis),
                      "event_type": nul_i, "id": nul_s, "attrs": nul_m})
    bodies = F.filter(F.array(F.when(eid == F.col("v_eid"), vis_body).otherwise(nul_b),
                              F.when(eid == F.col("s_eid"), ses_body).otherwise(nul_b), body),
                      lambda b: b.isNotNull())
    return j.select(F.expr("event_id div 5").alias("request_id"), eid.alias("event_id"), uid.alias("user_id"),
                    "day", "k", "ms", F.posexplode(bodies).alias("sub", "body"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request envelopes (REQUEST schema) built from the driver events.

    The grouping is by request id, five events per group by construction.
    """
    from webmetrics import schema as S
    re_ = request_events(spark, sf_dir)
    g = re_.groupBy("request_id").agg(
        F.min_by(F.struct("user_id", "k", "day"), F.struct("event_id", "sub")).alias("h"),
        F.min("ms").alias("lo"), F.max("ms").alias("hi"),
        F.array_sort(F.collect_list(F.struct("event_id", "sub", "body")),
                     lambda x, y: F.signum((x["event_id"] - y["event_id"]) * 4 + x["sub"] - y["sub"])
                     .cast("int")).alias("evs"))
    u, k0, d0 = F.col("h.user_id"), F.col("h.k"), F.col("h.day")
    t0 = F.pmod(u, F.lit(4))
    f20, f10 = F.pmod(k0, F.lit(20)), F.pmod(k0, F.lit(10))
    origin = (F.when(f20 == 17, F.lit(None).cast("string")).when(f20 == 14, F.lit("https://"))
               .otherwise(F.concat(F.lit("https://"), site_of(t0), F.lit("/app"))))
    api_key = (F.when(f20 == 18, F.lit(None).cast("string")).when(f20 == 16, F.lit("  "))
                .when(f20 == 15, F.concat(F.lit(" "), api_key_of(t0), F.lit(" ")))
                .otherwise(api_key_of(t0)))
    ua = F.when(f20 != 19, user_agent_of("_u", "_d"))
    ip = F.when(F.pmod(k0, F.lit(7)) == 0,
                F.concat(F.lit("2001:db8::"), F.pmod(u, F.lit(10000)).cast("string"))
                ).otherwise(ipv4_of("_u", "_d"))
    recv = (F.when(f10 == 0, F.col("hi") - 600_000).when(f10 == 9, F.col("lo") + 3_660_000)
              .otherwise(F.col("hi") + f10 * 60_000))
    events = F.when(f20 == 13, F.array().cast(S.REQUEST["events"].dataType)).otherwise(
        F.transform("evs", lambda x: x["body"]))
    return (g.withColumn("_u", u).withColumn("_d", d0).select(
        "request_id", F.timestamp_millis(recv).alias("received_at"), origin.alias("origin"),
        api_key.alias("api_key"), ua.alias("user_agent"), ip.alias("ip"), events.alias("events")))


# --------------------------------------------------------------------------- action log

def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client action log from the driver events (client = user, seq = event_id):
    view -> registerSection (registerSession when k%10 = 7), purchase and click
    -> registerClick, signup -> registerVisitor, error -> deregister of the
    visitor / session / section by k%3."""
    e = read(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    et = F.col("event_type")
    act = (F.when((et == "view") & (F.pmod(k, F.lit(10)) == 7), F.lit("registerSession"))
            .when(et == "view", F.lit("registerSection"))
            .when(et.isin("purchase", "click"), F.lit("registerClick"))
            .when(et == "signup", F.lit("registerVisitor"))
            .when(F.pmod(k, F.lit(3)) == 0, F.lit("deregisterVisitor"))
            .when(F.pmod(k, F.lit(3)) == 1, F.lit("deregisterSession"))
            .otherwise(F.lit("deregisterSection")))
    t = F.pmod("user_id", F.lit(4))
    is_x = act.isin("registerSection", "registerClick")
    return e.select(
        api_key_of(t).alias("api_key"), F.col("user_id").cast("string").alias("client"),
        F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("ts"), act.alias("action"),
        F.when(is_x, location_of(site_of(t), k)).alias("location"),
        F.when(is_x, F.concat(path_of(k), F.lit(" | Demo"))).alias("title"))
