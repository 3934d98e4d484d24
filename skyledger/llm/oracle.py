"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

# Exact similarity of all pairs that share a shingle, then components by reachability.
OP1 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
flat AS (SELECT doc_id, unnest(s) AS g FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common_n FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
linked AS (
  SELECT a, b FROM shared JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
  WHERE 100 * common_n >= 85 * (len(x.s) + len(y.s) - common_n)),
sides AS (SELECT a, b FROM linked UNION SELECT b, a FROM linked),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, s.b FROM reach r JOIN sides s ON s.a = r.other),
low AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN low USING (doc_id)
"""

OP6 = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS h FROM p),
g AS (SELECT *, min(page_id) OVER (PARTITION BY h, payload_bytes) AS first FROM d)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM g
"""

OP7 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, length(text) + (length(text) - length(replace(text, '\', '')))
    + (length(text) - length(replace(text, '###', ''))) // 3 + (length(text) - length(replace(text, '</turn>', ''))) // 7
    + CASE role WHEN 'system' THEN 12 WHEN 'user' THEN 10 WHEN 'assistant' THEN 15 END + 9 AS shown FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(shown) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

OP9 = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
n AS (SELECT vec_id, label, list_transform(e, lambda x: x / sqrt(list_inner_product(e, e))) AS u FROM v
      WHERE label IS NOT NULL AND list_inner_product(e, e) > 0),
linked AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.u) = len(b.u)
  WHERE list_inner_product(a.u, b.u) >= 0.98),
reach AS (SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN linked l ON l.a = r.other),
low AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY 1),
c AS (SELECT a AS vec_id, count(*) AS n FROM linked GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM low LEFT JOIN c USING (vec_id)
"""


# Every matching document scored in full.
OP12 = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
tf AS (
  SELECT r, doc_id, term, count(*) AS tf
  FROM (SELECT r, doc_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM texts) GROUP BY ALL),
sizes AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY 1),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
m AS (SELECT r, 10 + (90 * n * docs) // terms AS m FROM sizes, totals),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, totals WHERE term IN (SELECT term FROM items) GROUP BY term, docs),
scores AS (
  SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM items JOIN weights USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY ALL),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

# Row by row, the cheapest then least edits into each of the four states, with what they make.
OP13 = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
drawn AS (
  SELECT *, xor(list_reduce(flatten(list_transform(string_split(k, ''), lambda c: [ord(c), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END) END,
    CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS kind FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) FROM drawn WHERE kind <> 0)),
seen AS (
  SELECT *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth FROM damaged),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, nth) AS i FROM seen),
marked AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
made(s, t, inserts, lines) AS (VALUES
  (0, 0, '', ''), (0, 2, 'I', chr(10) || 'user:'), (0, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
  (1, 1, '', ''), (1, 2, 'I', chr(10) || 'user:'), (1, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
  (2, 2, '', ''), (2, 3, 'I', chr(10) || 'assistant:'), (2, 2, 'II', chr(10) || 'assistant:' || chr(10) || 'user:'),
  (3, 3, '', ''), (3, 2, 'I', chr(10) || 'user:'), (3, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')),
walk AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, 0 AS s, {'cost': CAST(0 AS BIGINT), 'audit': '', 'made': ''} AS best FROM marked
  UNION ALL
  SELECT conv_id, i, s, min(best) FROM (
    SELECT w.conv_id, r.i, e.s, {'cost': w.best.cost + 3 * length(m.inserts) + e.cost,
        'audit': w.best.audit || m.inserts || e.letter, 'made': w.best.made || m.lines || e.line} AS best
    FROM walk w JOIN marked r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1 JOIN made m ON m.s = w.s,
    LATERAL (
      SELECT m.t AS s, 4 AS cost, 'D' AS letter, '' AS line
      UNION ALL SELECT CASE WHEN m.t = 2 THEN 3 ELSE 2 END, 3 + CASE r.fault WHEN 'truncated' THEN 3 ELSE 0 END, 'R',
        chr(10) || CASE WHEN m.t = 2 THEN 'assistant' ELSE 'user' END || ':' || r.text WHERE r.fault NOT IN ('blank', 'duplicate')
      UNION ALL SELECT CASE left(r.role, 1) WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, CASE r.fault WHEN 'truncated' THEN 3 ELSE 0 END, 'K',
        chr(10) || r.role || ':' || r.text WHERE r.fault NOT IN ('blank', 'duplicate')
          AND ((left(r.role, 1) = 's' AND m.t = 0) OR (left(r.role, 1) = 'u' AND m.t <> 2) OR (left(r.role, 1) = 'a' AND m.t = 2))) e)
  GROUP BY conv_id, i, s),
last AS (SELECT conv_id, max(i) AS n FROM marked GROUP BY 1),
ended AS (
  SELECT w.conv_id, min({'cost': w.best.cost + 3 * length(m.inserts), 'audit': w.best.audit || m.inserts, 'made': w.best.made || m.lines}) AS best
  FROM walk w JOIN last l ON l.conv_id IS NOT DISTINCT FROM w.conv_id AND l.n = w.i JOIN made m ON m.s = w.s AND m.t IN (0, 3) GROUP BY 1),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (i > 1 AND before || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal FROM marked GROUP BY 1)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(e.best.cost, 0) AS cost,
  coalesce(e.best.audit, '') AS audit, sha256(coalesce(substr(e.best.made, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_minhash": OP1, "op6_warc": OP6, "op7_chat": OP7, "op9_embeddings": OP9, "op12_ranked": OP12, "op13_repair": OP13}
