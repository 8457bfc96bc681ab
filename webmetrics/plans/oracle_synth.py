"""DuckDB twin of the synthetic job (N1-N10): the same draws, set-based joins in place of
the formulas that a child repeats for its parent."""

from __future__ import annotations

from webmetrics.plans import oracle as O

API_KEY, SITE = "key-0", "site0.example.com"
PARTS = {"p1": "['/shop/', '/blog/', '/help/', '/team/', '/docs/', '/jobs/']",
         "p2": "['', 'spring/', 'summer/', 'autumn/', 'winter/', 'archive/']",
         "r": "['index', 'list', 'detail', 'search', 'print', 'feed']"}
_PLATFORM = ("['Windows NT 10.0; Win64; x64', 'Macintosh; Intel Mac OS X 10_15_7', 'X11; Linux x86_64', "
             "'Linux; Android 14; Pixel 8', 'iPhone; CPU iPhone OS 17_1_2 like Mac OS X']")


def _u(tag: int, n: str) -> str:
    """Uniform [0, 1): 52 bits of the MD5 of seed (7), tag and number."""
    return f"(CAST('0x' || substr(md5('7:{tag}:' || ({n})), 1, 13) AS BIGINT)::DOUBLE / 4503599627370496)"


def _normal(tag: int, n: str, mu: str, sd: str) -> str:
    return (f"(sqrt(-2 * ln(1 - {_u(tag, n)})) * cos(2 * pi() * {_u(tag + 1_000_003, n)}) * ({sd})::DOUBLE + ({mu})::DOUBLE)")


def _path(i: str) -> str:
    return f"{PARTS['p1']}[{i} // 36 + 1] || {PARTS['p2']}[({i} // 6) % 6 + 1] || {PARTS['r']}[{i} % 6 + 1]"


_SPIKE = f"(- ln(1 - {_u(3, 'i')}) * 1.3::DOUBLE)"

CTES = f"""
par AS (SELECT count(DISTINCT user_id)::BIGINT AS b, (epoch_us(max(ts)) // 1000000)::BIGINT AS last_s FROM events),
agent_parts AS (
  SELECT i::INT AS rv, {_PLATFORM}[i % 5 + 1] AS platform, (i // 5) % 5 AS k, 100 + i // 25 * 7 AS v, i // 25 AS m
  FROM range(100) t(i)),
agent AS (
  SELECT rv, 'Mozilla/5.0 (' || platform || ') AppleWebKit/537.36 (KHTML, like Gecko) ' ||
    CASE k WHEN 0 THEN 'Chrome/' || v || '.0.0.0 Safari/537.36'
           WHEN 1 THEN 'Firefox/' || v || '.0'
           WHEN 2 THEN 'Chrome/' || v || '.0.0.0 Safari/537.36 Edg/' || v || '.0.1.2'
           WHEN 3 THEN 'Version/17.' || m || ' Safari/605.1.15'
           ELSE 'Chrome/' || v || '.0.0.0 Mobile Safari/537.36' END AS user_agent
  FROM agent_parts),
browser AS (SELECT rv, user_agent, {O.ua_columns('user_agent')} FROM agent),
syn_v AS (
  SELECT i AS rn, floor(last_s - {_u(1, 'i')} * 86400 - 86400 * CASE
      WHEN i < 10 * b THEN {_u(2, 'i')} * 365
      WHEN i < 14 * b THEN 320 - {_SPIKE} WHEN i < 17 * b THEN 177 - {_SPIKE} ELSE 48 - {_SPIKE} END)::BIGINT AS vs
  FROM (SELECT unnest(range(20 * b)) AS i, b, last_s FROM par)),
syn_s0 AS (
  SELECT i AS sn, last_s, 20 * b AS nv,
         CASE WHEN i < 20 * b THEN i
              ELSE ((floor({_normal(4, 'i', '20 * b / 2', '20 * b / 3')})::BIGINT % (20 * b)) + 20 * b) % (20 * b) END AS rn
  FROM (SELECT unnest(range(200 * b)) AS i, b, last_s FROM par)),
syn_s AS (
  SELECT sn, syn_s0.rn, vs, CASE WHEN sn < nv THEN vs ELSE last_s - floor({_u(5, 'sn')} * (last_s - vs))::BIGINT END AS ss,
         floor({_u(6, 'sn')} * 4294967296)::BIGINT AS ip
  FROM syn_s0 JOIN syn_v ON syn_s0.rn = syn_v.rn),
syn_x0 AS (
  SELECT i AS xn, 200 * b AS ns, CASE WHEN i < 200 * b THEN i ELSE floor({_u(7, 'i')} * (200 * b))::BIGINT END AS sn,
         floor(abs({_normal(9, 'i', '0', '55')}))::BIGINT % 216 AS pi
  FROM (SELECT unnest(range(2000 * b)) AS i, b FROM par)),
syn_x AS (
  SELECT xn, x.sn, pi, ss, CASE WHEN xn < ns THEN ss ELSE ss + floor({_u(8, 'xn')} * 3600)::BIGINT END AS xs
  FROM syn_x0 x JOIN syn_s s ON x.sn = s.sn),
syn_session AS (
  SELECT '{API_KEY}' AS api_key, '{SITE}' AS site, {O.uuid7('ss * 1000', '2', 'sn')} AS id, epoch_ms(ss * 1000) AS ts,
         {O.uuid7('vs * 1000', '1', 'rn')} AS parent, {O.ip_text('ip')} AS ipv4, ip, browser.* EXCLUDE (rv)
  FROM syn_s JOIN browser ON rn % 100 = rv),
syn_section AS (
  SELECT '{API_KEY}' AS api_key, '{SITE}' AS site, {O.uuid7('xs * 1000', '3', 'xn')} AS id, epoch_ms(xs * 1000) AS ts,
         {O.uuid7('ss * 1000', '2', 'sn')} AS parent, {_path('pi')} AS path
  FROM syn_x)
"""

#: Where the generated addresses lie in the blocks of the model.
GEO = """
syn_geo AS (
  SELECT ip, arg_min(country_code, (e - s, s)) AS country_code, arg_min(city, (e - s, s)) AS city
  FROM (SELECT DISTINCT ip FROM syn_session) JOIN blocks ON ip BETWEEN s AND e GROUP BY ip)
"""


def _with(select: str) -> str:
    return "WITH " + CTES.strip() + "\n" + select


PATHS = f"""
    WITH c AS (SELECT i::INT AS rv, {PARTS['p1']}[i // 36 + 1] AS path1, {PARTS['p2']}[(i // 6) % 6 + 1] AS path2,
                      {PARTS['r']}[i % 6 + 1] AS resource FROM range(216) t(i)),
    n AS (SELECT (event_id % 216)::INT AS rv, count(*) AS events FROM events GROUP BY 1)
    SELECT rv, path1, path2, resource, path1 || path2 || resource || ' | Demo' AS title, events FROM c JOIN n USING (rv)"""
BROWSERS = _with("SELECT browser.*, users FROM browser JOIN (SELECT (user_id % 100)::INT AS rv, "
                 "count(DISTINCT user_id) AS users FROM events GROUP BY 1) USING (rv)")
VISITORS = _with(f"SELECT '{API_KEY}' AS api_key, '{SITE}' AS site, 'Visitor' AS event_type, "
                 f"{O.uuid7('vs * 1000', '1', 'rn')} AS id, epoch_ms(vs * 1000) AS ts, 'synthetic' AS channel FROM syn_v")
SESSIONS = _with("SELECT * EXCLUDE (ip), 'unknown' AS country_code, 'unknown' AS state, 'unknown' AS city FROM syn_session")
SECTIONS = _with(f"SELECT api_key, site, 'Section' AS event_type, id, ts, parent, 'https://{SITE}' || path AS location, "
                 "path || ' | Demo' AS title FROM syn_section")
COMBINED = O.with_model(
    "SELECT x.api_key, x.site, epoch_ms(epoch_ms(x.ts) // 300000 * 300000) AS ts, x.path, s.os, s.browser, "
    "coalesce(g.country_code, 'unknown') AS country_code, coalesce(g.city, 'unknown') AS city, s.parent AS visitor "
    "FROM syn_section x JOIN syn_session s ON x.parent = s.id LEFT JOIN syn_geo g ON s.ip = g.ip",
    CTES.strip() + "," + GEO)
