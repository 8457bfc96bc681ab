"""DuckDB SQL for the operators' queries that SQL can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
A_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
LOWERED = r"regexp_extract_all(translate(coalesce(text, ''), " + A_Z + r"), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

WINDOWS = f"""
WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i+12], ' ')) AS k
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
least AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
hit AS (SELECT DISTINCT doc_id, i + j AS p FROM win JOIN least USING (k), range(0, 13) r(j) WHERE m < doc_id),
one AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n
         FROM one ANTI JOIN hit USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

_B32 = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
_DIGITS = " || ".join(
    f"substr({_B32}, (((('0x' || substr(h, {10 * g + 1}, 10))::BIGINT) >> {35 - 5 * i}) & 31)::INT + 1, 1)"
    for g in range(4) for i in range(8))

PAYLOADS = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
q AS (SELECT page_id, strlen(t)::BIGINT AS payload_bytes, sha1(t) AS h, max(page_id) OVER (PARTITION BY t) AS keep FROM p)
SELECT page_id, payload_bytes, {_DIGITS} AS payload_digest,
       CASE WHEN keep = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN keep <> page_id THEN keep END AS refers_to
FROM q
"""

MIX = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS key, md5(doc_id::VARCHAR) AS h FROM documents),
parts AS (SELECT greatest(1, (count(*) + 4095) // 4096) AS p FROM d),
ranked AS (
  SELECT doc_id, source, key, row_number() OVER (PARTITION BY key ORDER BY ('0x' || substr(h, 1, 8))::BIGINT % p, h, doc_id) - 1 AS rank
  FROM d, parts),
x AS (SELECT key, (count(*) + 15) // 16 AS blocks, pow(count(*), 0.7) / sum(pow(count(*), 0.7)) OVER () * 1000 AS x FROM d GROUP BY key),
f AS (SELECT *, greatest(floor(x), 1)::BIGINT AS low, 1000 - sum(greatest(floor(x), 1)::BIGINT) OVER () AS spare FROM x),
src AS (
  SELECT key, blocks, row_number() OVER (ORDER BY key) AS number,
         low + CASE WHEN row_number() OVER (ORDER BY low - x, key) <= spare THEN 1 ELSE 0 END AS share FROM f),
lists AS (SELECT list(share ORDER BY number) AS s FROM src),
edf AS (
  SELECT 0 AS t, s, list_transform(s, lambda v: 0::BIGINT) AS k, 0::BIGINT AS pick, 0::BIGINT AS nth FROM lists
  UNION ALL
  SELECT t + 1, s, list_transform(range(1, len(s) + 1), lambda i: k[i] + CASE WHEN i = p THEN 1 ELSE 0 END), p, k[p]
  FROM (SELECT t, s, k, list_min(list_filter(list_transform(range(1, len(s) + 1), lambda i:
          CASE WHEN k[i] < s[i] AND (k[i] * 1000) // s[i] <= t THEN (((k[i] + 1) * 1000 + s[i] - 1) // s[i]) * 100000 + i END),
          lambda v: v IS NOT NULL)) % 100000 AS p FROM edf WHERE t < 1000)),
slots AS (SELECT pick AS number, nth, t - 1 AS tick FROM edf WHERE t > 0),
ends AS (
  SELECT max(((blocks - 1) // share) * 1000 + tick) + 1 AS n
  FROM src JOIN slots ON slots.number = src.number AND nth = (blocks - 1) % share),
runs AS (
  SELECT doc_id, source, rank % 16 AS place, e AS epoch, e * blocks + rank // 16 AS k, share, number, n
  FROM ranked JOIN src USING (key), ends, range(0, ((n // 1000 + 1) * share + blocks - 1) // blocks) g(e))
SELECT doc_id, source, ((k // share) * 1000 + tick)::BIGINT AS slot, place::BIGINT AS place, epoch::BIGINT AS epoch
FROM runs JOIN slots ON slots.number = runs.number AND nth = k % share
WHERE (k // share) * 1000 + tick < n
"""

NEAR = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {A_Z}), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i+4], ' ')) AS s
       FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, component_id = w.doc_id AS kept
FROM w JOIN comp USING (doc_id) LEFT JOIN n USING (doc_id)
"""

LEAKS = f"""
WITH w AS (SELECT doc_id, {LOWERED} AS ws FROM documents),
b AS (SELECT item_id, {LOWERED} AS ws FROM benchmark),
items AS (SELECT DISTINCT item_id, least(len(ws), 10) AS size, md5(array_to_string(ws[i:i+least(len(ws), 10)-1], ' ')) AS k
          FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM b WHERE len(ws) > 0)),
win AS (SELECT doc_id, i, size, md5(array_to_string(ws[i:i+size-1], ' ')) AS k
        FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM w, (SELECT DISTINCT size FROM items))),
met AS (SELECT doc_id, i, size, item_id FROM win JOIN items USING (size, k)),
hit AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM met, range(0, 10) r(j) WHERE j < size GROUP BY doc_id),
who AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS t
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM met) GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(who.n, 0)::BIGINT AS n_items,
       sha256(coalesce(who.t, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN who USING (doc_id)
"""

SHARDS = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, strlen(coalesce(text, ''))::BIGINT + 8 AS size FROM documents),
n AS (SELECT count(*) AS rows, greatest(1, (sum(size) + (16 << 20) - 1) // (16 << 20))::BIGINT AS buckets FROM d),
drawn AS (SELECT doc_id, ('0x' || substr(md5('11:' || doc_id::VARCHAR), 1, 13))::BIGINT AS draw FROM d),
fixed AS (SELECT doc_id, draw % buckets AS bucket,
                 row_number() OVER (PARTITION BY draw % buckets ORDER BY draw, doc_id::VARCHAR) AS place FROM drawn, n),
each AS (SELECT bucket, count(*) AS n, list(doc_id ORDER BY place) AS ids FROM fixed GROUP BY bucket),
swaps AS (SELECT bucket, list(i + 1 ORDER BY i DESC) AS hi, list(('0x' || substr(md5('11:' || bucket || ':' || i), 1, 13))::BIGINT % (i + 1) + 1 ORDER BY i DESC) AS lo
          FROM (SELECT bucket, unnest(range(1, n)) AS i FROM each) GROUP BY bucket),
mixed AS (SELECT bucket, n, coalesce(sum(n) OVER (ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first,
                 list_reduce(list_transform(coalesce(hi, []::BIGINT[]), lambda x, k: [x, lo[k]]),
                   lambda a, s: list_transform(a, lambda x, k: CASE WHEN k = s[1] THEN a[s[2]] WHEN k = s[2] THEN a[s[1]] ELSE x END), ids) AS ids
          FROM each LEFT JOIN swaps USING (bucket)),
ranked AS (SELECT unnest(ids) AS doc_id, first + unnest(range(0, n)) AS rank FROM mixed),
dealt AS (SELECT doc_id, rank, (rank * 24) // rows AS shard, rows FROM ranked, n),
crc_table AS (SELECT list(list_reduce(range(0, 8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, b) ORDER BY b) AS crc
              FROM range(0, 256) r(b)),
summed AS (SELECT doc_id, size, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda h: ('0x' || h)::BIGINT),
             lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)::BIGINT AS text_crc32 FROM d, crc_table)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard::INT AS shard, (rank - (shard * rows + 23) // 24)::BIGINT AS slot, NULL::INT AS grown_shard
FROM dealt JOIN summed USING (doc_id)
"""

_FLOOR = "((s - ((s % n) + n) % n) // n)"      # floor of the exact quotient, n > 0


def _rounds(t: str, rounds: int, by: str = "") -> str:
    """Assignment and moving of entries (by part, if any), a pair of steps a round; the last one assigns only."""
    out, on = [], "USING (part)" if by else "ON true"
    for r in range(rounds + 1):
        out.append(f"""{t}_at{r} AS MATERIALIZED (
  SELECT id, {by} arg_min(entry, {{'d': d, 'entry': entry}}) AS entry, min(d) AS d FROM (
    SELECT id, {by} entry, list_sum(list_transform(x.v, lambda c, i: (c - e.v[i]) * (c - e.v[i])))::BIGINT AS d FROM {t}_x x JOIN {t}_e{r} e {on})
  GROUP BY ALL)""")
        if r < rounds:
            out.append(f"""{t}_e{r + 1} AS MATERIALIZED (
  SELECT {by} entry, coalesce(m.v, e.v) AS v FROM {t}_e{r} e LEFT JOIN (
    SELECT {by} entry, list({_FLOOR} ORDER BY i) AS v FROM (
      SELECT {by} entry, i, sum(c)::BIGINT AS s, count(*)::BIGINT AS n FROM (
        SELECT {by} entry, unnest(v) AS c, generate_subscripts(v, 1) AS i FROM {t}_at{r} JOIN {t}_x USING ({by} id)) GROUP BY ALL)
    GROUP BY ALL) m USING ({by} entry))""")
    return ",\n".join(out)


_USABLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

CODES = f"""
WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings WHERE {_USABLE}),
c_x AS MATERIALIZED (SELECT vec_id AS id, part, v[part * (len(v) // 4) + 1:(part + 1) * (len(v) // 4)] AS v FROM kept, range(0, 4) p(part)),
c_e0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY id) - 1 AS entry, v
  FROM c_x WHERE id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 256)),
{_rounds("c", 4, "part,")},
coded AS (SELECT id AS vec_id, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM c_at4 GROUP BY id),
digest AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS h FROM c_e4)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM coded JOIN kept USING (vec_id), digest
"""

CLUSTERS = f"""
WITH k_x AS MATERIALIZED (SELECT vec_id AS id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE {_USABLE} AND len(embedding) = 64),
k_e0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || id)) - 1 AS entry, v FROM k_x QUALIFY entry < 16),
{_rounds("k", 3)}
SELECT id AS vec_id, a.entry::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.entry))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(e.v, ',')) AS centroid_sha256
FROM k_at3 a JOIN k_e3 e USING (entry)
"""
