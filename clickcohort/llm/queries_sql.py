"""DuckDB SQL with the same rows as the queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# Sources ordered by code point weigh 1, 2, 3; the smallest caps (3 times the size) by weight
# are reached first, so the share per weight is settled at the first that is not reached.
ORACLES["op1_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source,
         CASE WHEN text IS NULL THEN 0
              ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS place
  FROM documents),
totals AS (
  SELECT source, sum(size)::BIGINT AS n,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY 3.0 * n / w, source NULLS LAST) AS k FROM totals),
sums AS (
  SELECT *, sum(n) OVER () - coalesce(sum(3 * n) OVER (ORDER BY k ROWS BETWEEN
                UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM ranked),
edge AS (SELECT min(k) AS k FROM sums WHERE rest * w <= 3 * n * weights),
wanted AS (
  SELECT s.source, s.n,
         CASE WHEN s.k < e.k THEN (3 * s.n)::DOUBLE
              ELSE (f.rest * s.w)::DOUBLE / f.weights::DOUBLE END AS target
  FROM sums s, edge e, sums f WHERE f.k = e.k),
quota AS (
  SELECT *, floor(target + 0.5)::BIGINT AS q FROM wanted),
run AS (
  SELECT d.*, t.n, t.target, CASE WHEN t.n > 0 THEN t.q // t.n ELSE 0 END AS times,
         CASE WHEN t.n > 0 THEN t.q % t.n ELSE 0 END AS left_over,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.doc_id
                           ROWS UNBOUNDED PRECEDING) - d.size AS before
  FROM sized d JOIN quota t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, n AS source_size, target,
       (times * size + greatest(0, least(size, left_over - before)))::BIGINT AS taken
FROM run
"""

ORACLES["op5_url_rules"] = r"""
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
rules(verdict, rule_host, rule_path) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fits AS (
  SELECT p.host, p.path, r.verdict, r.rule_host || r.rule_path AS rule,
         row_number() OVER (PARTITION BY p.host, p.path
                            ORDER BY length(r.rule_host || r.rule_path) DESC) AS k
  FROM (SELECT DISTINCT host, path FROM parts) p JOIN rules r
    ON starts_with(p.path, r.rule_path)
   AND (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON f.host = p.host AND f.path = p.path AND f.k = 1
"""

# Components are whole numbers, so the scores are exact on both sides.
ORACLES["op8_pivot_topk"] = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM pairs)
SELECT query_id, k::INTEGER AS rank, vec_id, score FROM ranked WHERE k <= 10
"""

ORACLES["op9_chat"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES
    (-7, 0, 'user', '\### Assistant: </turn> ok'),
    (-7, 1, 'assistant', '\### Assistant: </turn> ok')) AS extra(conv_id, turn, role, text)),
escaped AS (
  SELECT *, replace(replace(replace(replace(text, '\', '\\'), '<turn>', '<\turn>'),
                            '<say>', '<\say>'), '</turn>', '<\/turn>') AS body,
         replace(replace(replace(replace(role, '\', '\\'), '<turn>', '<\turn>'),
                         '<say>', '<\say>'), '</turn>', '<\/turn>') AS head
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), ''
                         ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, ''
                         ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       sum(length('<turn><say></turn>') + 1 + length(head) + length(body))::BIGINT
         AS formatted_chars
FROM escaped GROUP BY conv_id
"""

ORACLES["op11_lexical"] = r"""
WITH held AS (
  SELECT doc_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM held GROUP BY doc_id, term),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
total AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
item_terms AS (SELECT item_id, term, count(*) AS repeats FROM asked GROUP BY item_id, term),
weights AS (
  SELECT t.term, floor(1000 * ln((2 * any_value(s.n_docs) + 2)::DOUBLE
                                 / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf t CROSS JOIN total s WHERE t.term IN (SELECT term FROM item_terms) GROUP BY t.term),
impacts AS (
  SELECT t.doc_id, t.term,
         w.w * ((1000000000 * t.tf)
                // (1000 * t.tf + 12 * (75 + (25 * d.n * s.n_docs) // s.n_terms))) AS impact
  FROM tf t JOIN weights w ON t.term = w.term JOIN sizes d ON t.doc_id = d.doc_id
  CROSS JOIN total s),
scores AS (
  SELECT i.item_id, p.doc_id, sum(i.repeats * p.impact)::BIGINT AS score
  FROM item_terms i JOIN impacts p ON i.term = p.term GROUP BY i.item_id, p.doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
