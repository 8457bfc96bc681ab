"""Session enrichment: user-agent rules (D2-D5), IP geolocation.

Both lookups work on *distinct* keys first (distinct user agents, distinct
addresses), which are far fewer than sessions, and join the result back.
"""

from __future__ import annotations

import re
import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webmetrics import schema as S
from webmetrics.functions.net import host_mask, ipv4_to_long, range_to_cidr, shl
from webmetrics.operators import ua_table
from webmetrics.plans.strategy import CHECK_TTL_SECONDS, checked_broadcast
from webmetrics.session import checkpoint_dir

CASE_RULES = 100
_RULES: dict = {}
_GROUP = re.compile(r"\$(\d)")

KIND_ATTRS = {
    "os": ("os", "v1", "v2", "v3", "v4"),
    "browser": ("family", "v1", "v2"),
    "device": ("device", "brand", "model"),
}
KIND_DEFAULTS = {"os": S.OS_DEFAULTS, "browser": S.BROWSER_DEFAULTS, "device": S.DEVICE_DEFAULTS}


def load_rules(rules_df: DataFrame) -> list[tuple] | None:
    """Rule table -> sorted list (kind, priority, regex, repl), which becomes part of the plan;
    None beyond CASE_RULES rules, of which no more than one are read.
    """
    key = None
    try:
        key = (rules_df.sparkSession.sparkContext.applicationId, rules_df.semanticHash(), CASE_RULES)
    except Exception:  # pragma: no cover
        pass
    now = time.monotonic()
    if key in _RULES and now - _RULES[key][0] < CHECK_TTL_SECONDS:
        return _RULES[key][1]
    rows = rules_df.select("kind", "priority", "regex", "repl").limit(CASE_RULES + 1).collect()
    rules = sorted(((r.kind, r.priority, r.regex, dict(r.repl or {})) for r in rows),
                   key=lambda r: (r[0], r[1], r[2])) if len(rows) <= CASE_RULES else None
    if key is not None:
        _RULES[key] = (now, rules)
    return rules


def _sql_str(x: str) -> str:
    """Raw Spark SQL string literal (no escape processing of backslashes)."""
    if "'" in x:
        return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return "r'" + x + "'"


def _groups(regex: str) -> int:
    """Capturing groups of a Java regex: unescaped ( outside of a class, not followed by ?
    unless it names a group."""
    plain = re.sub(r"\\Q.*?(?:\\E|$)|\\.|\[\^?\]?(?:\\.|[^\]\\])*\]", "", regex)
    return len(re.findall(r"\((?!\?)|\(\?<[A-Za-z]", plain))


def template_sql(ua: str, regex: str, tmpl: str) -> str:
    """SQL text expanding ``$n`` group references of a replacement against ``regex``;
    a group that the regex does not have expands to ''."""
    parts, pos, groups = [], 0, _groups(regex)
    for m in _GROUP.finditer(tmpl):
        if m.start() > pos:
            parts.append(_sql_str(tmpl[pos:m.start()]))
        if int(m.group(1)) <= groups:
            parts.append(f"regexp_extract({ua}, {_sql_str(regex)}, {int(m.group(1))})")
        pos = m.end()
    if pos < len(tmpl):
        parts.append(_sql_str(tmpl[pos:]))
    if not parts:
        return "''"
    return parts[0] if len(parts) == 1 else "concat(" + ", ".join(parts) + ")"


def _kind_rules(rules: list[tuple], kind: str) -> list[tuple]:
    return sorted([r for r in rules if r[0] == kind], key=lambda r: (r[1], r[2]))


def first_match_sql(ua: str, rules: list[tuple], kind: str) -> str:
    """Index (1-based) of the first matching rule of ``kind`` by priority; 0 if none."""
    rs = _kind_rules(rules, kind)
    if not rs:
        return "0"
    whens = " ".join(f"WHEN {ua} RLIKE {_sql_str(r[2])} THEN {i}" for i, r in enumerate(rs, 1))
    return f"CASE {whens} ELSE 0 END"


def attr_sql(ua: str, idx: str, rules: list[tuple], kind: str, attr: str) -> str:
    default = _sql_str(KIND_DEFAULTS[kind].get(attr, ""))
    whens = [f"WHEN {i} THEN {template_sql(ua, r[2], r[3][attr])}"
             for i, r in enumerate(_kind_rules(rules, kind), 1) if attr in r[3]]
    return f"CASE {idx} {' '.join(whens)} ELSE {default} END" if whens else default


def parse_user_agent(df: DataFrame, rules: list[tuple], ua_col: str = "user_agent") -> DataFrame:
    """D2-D5 as a projection: adds device_brand, device_model, os, os_version,
    browser, browser_version. Regexes are literals, so each is compiled once
    per task; the first-match index per kind is computed once and shared by
    that kind's attributes."""
    ua = f"`{ua_col}`"
    step = df.select("*", *[F.expr(first_match_sql(ua, rules, k)).alias(f"_m_{k}") for k in KIND_ATTRS])

    def v(kind, attr):
        return attr_sql(ua, f"_m_{kind}", rules, kind, attr)

    out = step.selectExpr(
        "*",
        f"{v('device', 'brand')} AS device_brand",
        f"{v('device', 'device')} AS device_model",
        f"{v('os', 'os')} AS os",
        f"concat_ws('.', {v('os', 'v1')}, {v('os', 'v2')}, {v('os', 'v3')}) AS os_version",
        f"{v('browser', 'family')} AS browser",
        f"concat_ws('.', {v('browser', 'v1')}, {v('browser', 'v2')}) AS browser_version",
    )
    return out.drop(*[f"_m_{k}" for k in KIND_ATTRS])


UA_COLS = ("device_brand", "device_model", "os", "os_version", "browser", "browser_version")


def user_agents(df: DataFrame, rules_df: DataFrame, ua_col: str = "user_agent",
                distinct_first: bool = True) -> DataFrame:
    """Distinct-first UA enrichment: parse each distinct agent once, join back.

    Up to CASE_RULES rules are one generated expression, more are joined as a table
    (:mod:`ua_table`); both give the same rows.
    The parsed table is as large as the number of distinct agents; the join
    back is left to the planner (broadcast when AQE measures it small, else a
    skew-aware shuffle join on the agent text).
    """
    rules = load_rules(rules_df)
    key = F.coalesce(F.col(ua_col), F.lit(""))
    keyed = df.withColumn("_ua", key)
    if not distinct_first and rules is not None:  # row-wise: every row runs the rule chain (bench comparison)
        return parse_user_agent(keyed, rules, "_ua").drop("_ua")
    agents = keyed.select("_ua").distinct()
    if rules is not None:
        parsed = parse_user_agent(agents, rules, "_ua")
    else:
        checkpoint_dir(df.sparkSession)
        # read several times below: made once
        parsed = ua_table.parse(agents, ua_table.rule_table(rules_df).checkpoint(), "_ua")
    # AQE broadcasts the parsed table when it measures it small (32 MB), which spares
    # the sessions' shuffle by agent text; else it splits popular agents. No count
    # of derived data is run while the plan is built.
    return keyed.join(parsed, "_ua", "left").drop("_ua")


def ua_preview(session: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` parsed agents ordered by agent text (top-k, no full sort)."""
    return session.select("user_agent", *UA_COLS).orderBy("user_agent").limit(n)


# --------------------------------------------------------------------------- geo

def blocks_from_ranges(ranges: DataFrame, iso: DataFrame, mode: str = "range") -> DataFrame:
    """IP ranges -> lookup blocks with alpha-3 country, '' for blanks.

    ``mode='cidr'`` covers each range by the reference's CIDR rule (quirk Q4);
    ``mode='range'`` keeps start/end exactly.
    Output: start, end (long), net, plen, cidr, country_code, state, city,
    latitude, longitude.
    """
    s = ipv4_to_long(F.col("ip_range_start"))
    e = ipv4_to_long(F.col("ip_range_end"))
    r = ranges.select("*", s.alias("_s"), e.alias("_e"))
    c = range_to_cidr(F.col("_s"), F.col("_e"))
    iso2 = checked_broadcast(iso.select(F.col("cca2").alias("_cca2"), F.col("cca3").alias("_cca3"))
                             .where(F.col("_cca2").isNotNull()).dropDuplicates(["_cca2"]))
    j = r.join(iso2, r.country_code == iso2._cca2, "left")
    span = shl(F.lit(1).cast("long"), F.lit(32) - c["plen"]) - 1
    start = c["net"] if mode == "cidr" else F.col("_s")
    end = (c["net"] + span) if mode == "cidr" else F.col("_e")
    return j.select(
        start.alias("start"), end.alias("end"), c["net"].alias("net"), c["plen"].alias("plen"),
        c["cidr"].alias("cidr"),
        F.coalesce(F.col("_cca3"), F.lit("")).alias("country_code"),
        F.coalesce(F.col("state1"), F.lit("")).alias("state"),
        F.coalesce(F.col("city"), F.lit("")).alias("city"),
        F.col("latitude"), F.col("longitude"))


def _lookup_prefix(ips: DataFrame, blocks: DataFrame) -> DataFrame:
    """Longest-prefix match as an equi join: every address is expanded to the
    networks (plen, net) of the prefix lengths that occur among the blocks
    (at most 33 values), and blocks are joined on (plen, net)."""
    plens = sorted(r.plen for r in blocks.select("plen").distinct().limit(33).collect())
    p = F.explode(F.array(*[F.lit(int(x)) for x in plens] or [F.lit(32)])).alias("plen")
    x = ips.select("_ipkey", "_ip", p).select(
        "_ipkey", "plen",
        F.col("_ip").bitwiseAND(host_mask(F.col("plen"))).alias("net"))
    b = blocks.select("plen", "net", "country_code", "state", "city", "latitude", "longitude")
    m = x.join(checked_broadcast(b), ["plen", "net"])
    return m.groupBy("_ipkey").agg(F.max_by(
        F.struct("country_code", "state", "city", "latitude", "longitude"), F.col("plen")).alias("g"))


def range_pieces(start: str, end: str) -> Column:
    """The aligned blocks (k, n), n * 2^k .. (n + 1) * 2^k - 1, that make up [start, end]:
    at each size at most one on the left (odd number) and one on the right."""
    size = "bigint(shiftleft(1L, k))"
    return F.expr(f"""filter(flatten(transform(
        transform(sequence(0, 32), k -> named_struct('k', k,
            'l', shiftright({start} + {size} - 1L, k), 'r', shiftright({end} + 1L, k))),
        x -> array(named_struct('k', x.k, 'n', if(x.l < x.r and x.l % 2 = 1, x.l, null)),
                   named_struct('k', x.k, 'n', if(x.l < x.r and x.r % 2 = 1, x.r - 1L, null))))),
        x -> x.n is not null)""")


def _lookup_range(ips: DataFrame, blocks: DataFrame) -> DataFrame:
    """Exact range match as an equi join: a range is cut into its aligned blocks, and an
    address looked up in the blocks of the sizes (at most 33) that occur; the narrowest
    range wins."""
    place = F.struct("country_code", "state", "city", "latitude", "longitude").alias("place")
    pieces = blocks.select(F.explode(range_pieces("start", "end")).alias("p"), "start", "end", place).select(
        "p.k", "p.n", (F.col("end") - F.col("start")).alias("width"), "start", "place")
    sizes = sorted(r.k for r in pieces.select("k").distinct().limit(33).collect())
    k = F.explode(F.array(*[F.lit(int(x)) for x in sizes] or [F.lit(0)])).alias("k")
    x = ips.select("_ipkey", "_ip", k).select("_ipkey", "k", F.expr("shiftright(_ip, k)").alias("n"))
    # addresses times sizes are not shuffled where the ranges are proven small
    return x.join(checked_broadcast(pieces), ["k", "n"]).groupBy("_ipkey").agg(F.min_by("place", F.struct("width", "start")).alias("g"))


def geo_ip(df: DataFrame, blocks: DataFrame, ip_col: str = "ipv4", mode: str = "range") -> DataFrame:
    """Add country_code, state, city by IPv4 lookup; 'unknown' when unmatched.

    A missing or non-IPv4 address is looked up as 0.0.0.0 (as the reference
    does). Lookups run on distinct addresses and are joined back.
    """
    keyed = df.withColumn("_ipkey", F.coalesce(F.col(ip_col), F.lit("")))
    ips = keyed.select("_ipkey").distinct().select(
        "_ipkey", F.coalesce(ipv4_to_long(F.col("_ipkey")), F.lit(0).cast("long")).alias("_ip"))
    found = _lookup_prefix(ips, blocks) if mode == "cidr" else _lookup_range(ips, blocks)
    # at most one row per distinct address: broadcast by AQE when measured small,
    # else a join that splits hot addresses
    out = keyed.join(found, "_ipkey", "left")
    cols = [c for c in df.columns if c not in ("country_code", "state", "city")]
    return out.select(
        *cols,
        F.coalesce(F.col("g.country_code"), F.lit(S.UNKNOWN)).alias("country_code"),
        F.coalesce(F.col("g.state"), F.lit(S.UNKNOWN)).alias("state"),
        F.coalesce(F.col("g.city"), F.lit(S.UNKNOWN)).alias("city"))


SESSION_COLS = [f.name for f in S.SESSION_EVENT.fields]


def enrich_sessions(sessions: DataFrame, rules_df: DataFrame, blocks: DataFrame,
                    mode: str = "range") -> DataFrame:
    """A4 projection: routed sessions + device/os/browser + geo, SESSION_EVENT order."""
    s = user_agents(sessions, rules_df)
    s = geo_ip(s, blocks, "ipv4", mode)
    return s.select(*SESSION_COLS)
