"""DuckDB SQL twins of the registered queries (correctness oracles).

The SQL is written from the *semantics* (the reference's report templates
and view definitions, the adapter definitions), not from our Spark plans:
e.g. reports use the literal ``date_trunc('day', ts) >= from`` form while
the Spark side uses rewritten raw ranges. The user-agent CASE chains are
generated from the same rule table, since the rules are data.
"""

from __future__ import annotations

import re

from webmetrics.operators.enrich import KIND_DEFAULTS
from webmetrics.sources.catalogue import UA_RULES, USER_AGENTS

_GROUP = re.compile(r"\$(\d)")


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def uuid7(ms: str, a: str, b: str) -> str:
    h = f"lpad(lower(to_hex({ms})), 12, '0')"
    return (f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-7' || "
            f"lpad(lower(to_hex({a})), 3, '0') || '-8000-' || lpad(lower(to_hex({b})), 12, '0'))")


def sec_ts(ms: str) -> str:
    """Second-truncated timestamp of epoch milliseconds."""
    return f"epoch_ms(({ms}) // 1000 * 1000)"


def _tmpl(ua: str, regex: str, t: str) -> str:
    parts, pos = [], 0
    for m in _GROUP.finditer(t):
        if m.start() > pos:
            parts.append(q(t[pos:m.start()]))
        parts.append(f"regexp_extract({ua}, {q(regex)}, {m.group(1)})")
        pos = m.end()
    if pos < len(t):
        parts.append(q(t[pos:]))
    return " || ".join(parts) if parts else "''"


def ua_attr(ua: str, kind: str, attr: str, rules=UA_RULES) -> str:
    """First rule of ``kind`` (by priority) that matches, its ``attr`` replacement."""
    rs = sorted([r for r in rules if r[0] == kind], key=lambda r: (r[1], r[2]))
    default = q(KIND_DEFAULTS[kind].get(attr, ""))
    whens = []
    for _, _, regex, repl in rs:
        val = _tmpl(ua, regex, repl[attr]) if attr in repl else default
        whens.append(f"WHEN regexp_matches({ua}, {q(regex)}) THEN {val}")
    return f"(CASE {' '.join(whens)} ELSE {default} END)" if whens else default


def ua_columns(ua: str) -> str:
    os_v = " || '.' || ".join(ua_attr(ua, "os", a) for a in ("v1", "v2", "v3"))
    br_v = " || '.' || ".join(ua_attr(ua, "browser", a) for a in ("v1", "v2"))
    return (f"{ua_attr(ua, 'device', 'brand')} AS device_brand, "
            f"{ua_attr(ua, 'device', 'device')} AS device_model, "
            f"{ua_attr(ua, 'os', 'os')} AS os, {os_v} AS os_version, "
            f"{ua_attr(ua, 'browser', 'family')} AS browser, {br_v} AS browser_version")


_UA_LIST = "list_value(" + ", ".join(q(u) for u in USER_AGENTS) + ")"

# Common table expressions of the whole model over the driver tables.
MODEL_CTES = f"""
ev AS (
  SELECT event_id, user_id, event_type, epoch_us(ts) // 1000 AS ms,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         (epoch_us(ts) // 1000) // 86400000 AS day, user_id % 4 AS t
  FROM events),
sd AS (SELECT user_id, day, min((ms, event_id))[1] AS sms, min((ms, event_id))[2] AS s_eid
       FROM ev GROUP BY user_id, day),
vd AS (SELECT user_id, min((sms, s_eid))[1] AS vms, min((sms, s_eid))[2] AS v_eid FROM sd GROUP BY user_id),
keys AS (
  SELECT DISTINCT 'key-' || (user_id % 4) AS api_key, 'site' || (user_id % 4) || '.example.com' AS site
  FROM events WHERE user_id % 4 < 3),
visitor AS (
  SELECT 'key-' || (user_id % 4) AS api_key, 'site' || (user_id % 4) || '.example.com' AS site,
         {uuid7('vms', '1', 'user_id')} AS id, {sec_ts('vms')} AS ts
  FROM vd WHERE user_id % 4 < 3),
session_raw AS (
  SELECT 'key-' || (sd.user_id % 4) AS api_key, 'site' || (sd.user_id % 4) || '.example.com' AS site,
         {uuid7('sms', '2', 'sd.user_id')} AS id, {sec_ts('sms')} AS ts,
         {uuid7('vms', '1', 'sd.user_id')} AS parent,
         {_UA_LIST}[((sd.user_id + day) % 10) + 1] AS user_agent,
         '10.' || ((sd.user_id // 4) % 8) || '.' || (day % 4) || '.' || (sd.user_id % 250) AS ipv4,
         (10::BIGINT << 24) + (((sd.user_id // 4) % 8) << 16) + ((day % 4) << 8) + (sd.user_id % 250) AS ip
  FROM sd JOIN vd ON sd.user_id = vd.user_id WHERE sd.user_id % 4 < 3),
nr AS (
  SELECT n_nationkey AS n, n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey),
rng AS (
  SELECT (10::BIGINT << 24) + ((i // 3) << 16) + ((i % 3) << 8) AS s,
         (10::BIGINT << 24) + ((i // 3) << 16) + ((i % 3) << 8) + 255 AS e,
         (4 * (i // 3) + i % 3) % 25 AS n, 'slash24' AS kind, i % 3 AS b
  FROM range(21) t(i)
  UNION ALL
  SELECT (10::BIGINT << 24) + (a << 16), (10::BIGINT << 24) + (a << 16) + 65535, a, 'slash16', NULL
  FROM range(7) t(a)
  UNION ALL SELECT (192::BIGINT << 24) + (168 << 16), (192::BIGINT << 24) + (168 << 16) + 1, 5, 'extra', NULL
  UNION ALL SELECT (172::BIGINT << 24) + (16 << 16) + 5, (172::BIGINT << 24) + (16 << 16) + 20, 6, 'extra', NULL),
ip_range AS (
  SELECT s, e, 'N' || chr(CAST(65 + rng.n AS INTEGER)) AS cca2,
         CASE WHEN kind = 'slash16' THEN NULL ELSE r_name END AS state1,
         CASE kind WHEN 'slash24' THEN n_name || '/' || b WHEN 'slash16' THEN '' ELSE n_name END AS city
  FROM rng JOIN nr ON rng.n = nr.n),
iso AS (
  SELECT 'N' || chr(CAST(65 + n_nationkey AS INTEGER)) AS cca2, 'NA' || chr(CAST(65 + n_nationkey AS INTEGER)) AS cca3
  FROM nation WHERE n_nationkey <> 24),
blocks AS (
  SELECT s, e, coalesce(iso.cca3, '') AS country_code, coalesce(state1, '') AS state,
         coalesce(city, '') AS city
  FROM ip_range LEFT JOIN iso ON ip_range.cca2 = iso.cca2),
geo AS (
  SELECT ip, country_code, state, city FROM (
    SELECT ips.ip, b.country_code, b.state, b.city,
           row_number() OVER (PARTITION BY ips.ip ORDER BY b.e - b.s, b.s) AS rn
    FROM (SELECT DISTINCT ip FROM session_raw) ips JOIN blocks b ON ips.ip BETWEEN b.s AND b.e)
  WHERE rn = 1),
session AS (
  SELECT r.api_key, r.site, r.id, r.ts, r.parent, r.user_agent, r.ipv4,
         {ua_columns('r.user_agent')},
         coalesce(g.country_code, 'unknown') AS country_code, coalesce(g.state, 'unknown') AS state,
         coalesce(g.city, 'unknown') AS city
  FROM session_raw r LEFT JOIN geo g ON r.ip = g.ip),
kid AS (
  SELECT ev.*, sd.sms FROM ev JOIN sd ON ev.user_id = sd.user_id AND ev.day = sd.day
  WHERE ev.event_type IN ('view', 'purchase', 'click')),
section AS (
  SELECT 'key-' || t AS api_key, 'site' || t || '.example.com' AS site,
         {uuid7('ms', '3', 'event_id')} AS id, {sec_ts('ms')} AS ts,
         CASE WHEN k = 0 THEN {uuid7('ms', '5', 'event_id')} ELSE {uuid7('sms', '2', 'user_id')} END AS parent,
         '/dir' || (k % 6) || '/type' || (k % 5) AS path, 'k=' || k AS query, 's' || (k % 3) AS fragment,
         '/dir' || (k % 6) || '/type' || (k % 5) || ' | Demo' AS title,
         'https://site' || t || '.example.com/dir' || (k % 6) || '/type' || (k % 5) || '?k=' || k || '#s' || (k % 3) AS location
  FROM kid WHERE event_type IN ('view', 'purchase') AND t < 3 AND k <> 1),
click AS (
  SELECT 'key-' || t AS api_key, 'site' || t || '.example.com' AS site,
         {uuid7('ms', '4', 'event_id')} AS id, {sec_ts('ms')} AS ts, {uuid7('sms', '2', 'user_id')} AS parent
  FROM kid WHERE event_type = 'click'),
fact AS (
  SELECT x.api_key, x.site, epoch_ms(epoch_ms(x.ts) // 300000 * 300000) AS ts, x.path,
         s.os, s.browser, s.country_code, s.city, s.parent AS visitor
  FROM section x JOIN session s ON x.api_key = s.api_key AND x.site = s.site AND x.parent = s.id),
vts AS (
  SELECT api_key, site, epoch_ms(epoch_ms(ts) // 300000 * 300000) AS ts, count(*) AS visitors
  FROM visitor GROUP BY 1, 2, 3)
"""


def with_model(select: str, ctes: str = "") -> str:
    """Model CTEs (+ extra CTE text starting with its name) followed by ``select``."""
    extra = (",\n" + ctes.strip()) if ctes else ""
    return "WITH " + MODEL_CTES.strip() + extra + "\n" + select


UUID_RE_SQL = ("^([0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
               "|[0-9a-fA-F]{32})$")


def _uuid_ok(x: str) -> str:
    return f"coalesce(regexp_matches({x}, '{UUID_RE_SQL}'), false)"


def _uuid_ms(x: str) -> str:
    return f"CAST('0x' || substr(replace({x}, '-', ''), 1, 12) AS BIGINT)"


# Request envelopes and their validation, relationally (no arrays).
INGEST_CTES = f"""
rq_own AS (
  SELECT ev.event_id // 5 AS request_id, ev.event_id, 2 AS sub, ev.user_id, ev.day, ev.k, ev.ms, ev.event_type,
         ev.t,
         CASE WHEN ev.event_type IN ('view', 'purchase') THEN 3 WHEN ev.event_type = 'click' THEN 4
              WHEN ev.event_type = 'signup' THEN 2 WHEN ev.k % 50 = 49 THEN 5 ELSE 1 END AS typ,
         CASE WHEN ev.event_type IN ('view', 'purchase') THEN {uuid7('ev.ms', '3', 'ev.event_id')}
              WHEN ev.event_type = 'click' THEN {uuid7('ev.ms', '4', 'ev.event_id')}
              WHEN ev.event_type = 'signup' THEN {uuid7('ev.ms', '2', 'ev.event_id')}
              WHEN ev.k % 50 = 48 THEN 'not-a-uuid'
              WHEN ev.k % 2 = 0 THEN substr({uuid7('ev.ms', '1', 'ev.event_id')}, 1, 14) || '4' ||
                                     substr({uuid7('ev.ms', '1', 'ev.event_id')}, 16)
              ELSE {uuid7('ev.ms', '1', 'ev.event_id')} END AS bid,
         CASE WHEN ev.event_type IN ('view', 'purchase') AND ev.k = 1 THEN NULL
              WHEN ev.event_type IN ('view', 'purchase') AND ev.k = 2 THEN 'x'
              WHEN ev.event_type IN ('view', 'purchase') AND ev.k = 0 THEN {uuid7('ev.ms', '5', 'ev.event_id')}
              WHEN ev.event_type IN ('view', 'purchase', 'click') THEN {uuid7('sd.sms', '2', 'ev.user_id')}
              WHEN ev.event_type = 'signup' THEN {uuid7('vd.vms', '1', 'ev.user_id')} END AS p,
         (ev.event_type IN ('view', 'purchase') AND ev.k % 10 <> 3) AS has_lt,
         'https://site' || ev.t || '.example.com/dir' || (ev.k % 6) || '/type' || (ev.k % 5) || '?k=' || ev.k
           || '#s' || (ev.k % 3) AS location,
         '/dir' || (ev.k % 6) || '/type' || (ev.k % 5) || ' | Demo' AS title,
         sd.s_eid, vd.v_eid, sd.sms, vd.vms
  FROM ev JOIN sd ON ev.user_id = sd.user_id AND ev.day = sd.day JOIN vd ON ev.user_id = vd.user_id),
rq_all AS (
  SELECT request_id, event_id, sub, user_id, day, k, ms, t, typ, bid, p, has_lt, location, title FROM rq_own
  UNION ALL
  SELECT request_id, event_id, 0, user_id, day, k, ms, t, 1, {uuid7('vms', '1', 'user_id')}, NULL, false, NULL, NULL
  FROM rq_own WHERE event_id = v_eid
  UNION ALL
  SELECT request_id, event_id, 1, user_id, day, k, ms, t, 2, {uuid7('sms', '2', 'user_id')},
         {uuid7('vms', '1', 'user_id')}, false, NULL, NULL
  FROM rq_own WHERE event_id = s_eid),
rq_ev AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY request_id ORDER BY event_id, sub) - 1 AS INTEGER) AS pos
  FROM rq_all),
rq AS (
  SELECT request_id, arg_min(user_id, pos) AS u0, arg_min(k, pos) AS k0,
         arg_min(day, pos) AS d0, min(ms) AS lo, max(ms) AS hi, count(*) AS n
  FROM rq_ev GROUP BY request_id),
hdr AS (
  SELECT request_id, n, k0 % 20 = 13 AS empty,
         CASE WHEN k0 % 20 IN (14, 17) THEN NULL ELSE 'site' || (u0 % 4) || '.example.com' END AS site,
         CASE WHEN k0 % 20 = 18 THEN NULL WHEN k0 % 20 = 16 THEN '  '
              WHEN k0 % 20 = 15 THEN ' key-' || (u0 % 4) || ' ' ELSE 'key-' || (u0 % 4) END AS api_key,
         CASE WHEN k0 % 20 = 19 THEN NULL ELSE {_UA_LIST}[((u0 + d0) % 10) + 1] END AS user_agent,
         CASE WHEN k0 % 7 = 0 THEN '2001:db8::' || (u0 % 10000)
              ELSE '10.' || ((u0 // 4) % 8) || '.' || (d0 % 4) || '.' || (u0 % 250) END AS ip,
         epoch_ms(CASE WHEN k0 % 10 = 0 THEN hi - 600000 WHEN k0 % 10 = 9 THEN lo + 3660000
                       ELSE hi + (k0 % 10) * 60000 END) AS received_at
  FROM rq),
rq_body AS (
  SELECT r.*, h.received_at,
         CASE WHEN {_uuid_ok('r.bid')} THEN CAST('0x' || substr(replace(r.bid, '-', ''), 13, 1) AS INTEGER) END AS version,
         CASE WHEN {_uuid_ok('r.bid')} THEN epoch_ms({_uuid_ms('r.bid')} // 1000 * 1000) END AS ts
  FROM rq_ev r JOIN hdr h ON r.request_id = h.request_id WHERE NOT h.empty),
eerr AS (
  SELECT b.request_id, b.event_id, b.pos,
         (b.typ BETWEEN 1 AND 4 AND {_uuid_ok('b.bid')}) AS body_ok,
         CASE WHEN b.typ IN (2, 3, 4) AND NOT {_uuid_ok('b.p')} THEN 'InvalidRequestBody'
              WHEN length(trim(h.api_key)) = 0 THEN 'ApiKey'
              WHEN length(trim(h.site)) = 0 THEN 'Site'
              WHEN b.version <> 7 THEN 'UuidVersion'
              WHEN NOT (b.ts > h.received_at - INTERVAL 1 HOUR AND b.ts < h.received_at + INTERVAL 5 MINUTE)
                THEN 'TimestampOutOfRange' END AS err
  FROM rq_body b JOIN hdr h ON b.request_id = h.request_id),
eagg AS (
  SELECT request_id, bool_and(body_ok) AS body_ok,
         arg_min(err, pos) FILTER (WHERE err IS NOT NULL) AS first_err
  FROM eerr GROUP BY request_id),
chk AS (
  SELECT h.*, coalesce(
           CASE WHEN h.site IS NULL THEN 'InvalidRequestHeaders' WHEN h.api_key IS NULL THEN 'ApiKey'
                WHEN h.user_agent IS NULL THEN 'InvalidRequestHeaders' END,
           CASE WHEN NOT coalesce(a.body_ok, true) THEN 'InvalidRequestBody' END,
           a.first_err,
           CASE WHEN h.empty THEN 'InvalidRequest' END,
           CASE WHEN NOT EXISTS (SELECT 1 FROM keys WHERE keys.api_key = trim(h.api_key)
                                 AND keys.site = trim(h.site)) THEN 'UnknownSource' END) AS reason
  FROM hdr h LEFT JOIN eagg a ON h.request_id = a.request_id),
accepted AS (
  SELECT b.request_id, b.pos, trim(c.api_key) AS api_key, trim(c.site) AS site,
         CASE b.typ WHEN 1 THEN 'Visitor' WHEN 2 THEN 'Session' WHEN 3 THEN 'Section' ELSE 'Click' END AS event_type,
         lower(b.bid) AS id, b.ts, CASE WHEN b.typ IN (2, 3, 4) THEN lower(b.p) END AS parent,
         CASE WHEN b.typ = 2 THEN c.user_agent END AS user_agent,
         CASE WHEN b.typ = 2 AND NOT contains(c.ip, ':') THEN c.ip END AS ipv4,
         CASE WHEN b.typ = 2 AND contains(c.ip, ':') THEN c.ip END AS ipv6,
         CASE WHEN b.typ = 3 AND b.has_lt THEN b.location END AS location,
         CASE WHEN b.typ = 3 AND b.has_lt THEN b.title END AS title
  FROM rq_body b JOIN chk c ON b.request_id = c.request_id WHERE c.reason IS NULL)
"""


def with_ingest(select: str) -> str:
    return "WITH " + MODEL_CTES.strip() + ",\n" + INGEST_CTES.strip() + "\n" + select


STATUS_SQL = ("CASE WHEN reason IS NULL THEN 201 WHEN reason IN ('InvalidRequest', 'UnknownSource') "
              "THEN 500 ELSE 400 END")


def ip_text(x: str) -> str:
    return (f"(({x}) >> 24) || '.' || ((({x}) >> 16) & 255) || '.' || ((({x}) >> 8) & 255) "
            f"|| '.' || (({x}) & 255)")


CIDR_CTES = """
cidr AS (
  SELECT s, e, xor(s, e) AS x,
         CAST(CASE WHEN xor(s, e) <> 0 THEN ceil(log2(xor(s, e))) ELSE 0 END AS INTEGER) AS bits
  FROM ip_range),
cidr2 AS (
  SELECT s, e, 32 - bits AS plen, s & ~((1::BIGINT << bits) - 1) AS net, bits FROM cidr)
"""
