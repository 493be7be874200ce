"""SQL equivalents, for DuckDB, of the queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {
    "op5_chat": r"""WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
    length('<s>[ROLE][/ROLE]</s>') + length(replace(replace(replace(role, '\', '\0'), '<', '\1'), '[', '\2'))
      + length(replace(replace(replace(text, '\', '\0'), '<', '\1'), '[', '\2')) AS size,
    4 + len(list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS tokens
  FROM turns),
marked AS (
  SELECT s.*, s.place < coalesce(f.first_place, 1000000000) AS is_lead
  FROM sized s LEFT JOIN (SELECT conv_id, min(place) AS first_place FROM sized WHERE role <> 'system' GROUP BY conv_id) f
    ON s.conv_id = f.conv_id),
laid AS (
  SELECT *, coalesce(sum(CASE WHEN is_lead THEN 0 ELSE tokens END) OVER (
    PARTITION BY conv_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS tokens_before
  FROM marked),
cut AS (SELECT *, CASE WHEN is_lead THEN 0 ELSE CAST(tokens_before AS BIGINT) // 384 END AS win FROM laid),
heads AS (
  SELECT conv_id, win, min(CASE WHEN NOT is_lead THEN tokens_before END) AS start FROM cut GROUP BY conv_id, win),
chain AS (
  SELECT conv_id, win, lead(start) OVER (PARTITION BY conv_id ORDER BY win) AS next_start FROM heads),
again AS (
  SELECT c.conv_id, sum(c.size) AS size FROM cut c JOIN chain h ON c.conv_id = h.conv_id AND c.win = h.win
  WHERE NOT c.is_lead AND h.next_start - c.tokens_before <= 256 GROUP BY c.conv_id),
others AS (SELECT conv_id, count(*) AS n FROM heads WHERE win > 0 GROUP BY conv_id),
whole AS (
  SELECT conv_id, count(*) AS n_turns, sum(size) AS size, sum(CASE WHEN is_lead THEN size ELSE 0 END) AS lead_size,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY place), '') AS target
  FROM cut GROUP BY conv_id)
SELECT w.conv_id, w.n_turns, w.turns_sha256, CAST(length(w.target) AS BIGINT) AS loss_chars, sha256(w.target) AS loss_sha256,
  CAST(w.size + w.lead_size * coalesce(o.n, 0) + coalesce(a.size, 0) AS BIGINT) AS formatted_chars
FROM whole w LEFT JOIN others o ON w.conv_id = o.conv_id LEFT JOIN again a ON w.conv_id = a.conv_id""",
    "op6_topk": """WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT query_id, vec_id, score,
    CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
    "op8_url_filter": r"""WITH cut AS (
  SELECT page_id, url, CASE WHEN url IS NOT NULL AND contains(url, '://')
    THEN substring(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
rules(verdict, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fits AS (
  SELECT p.page_id, p.host, p.path, r.verdict, r.rhost || r.rpath AS rule, length(r.rhost) AS hlen, length(r.rpath) AS plen
  FROM parts p LEFT JOIN rules r
    ON (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM (
  SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY hlen DESC NULLS LAST, plen DESC) AS n FROM fits) t
WHERE n = 1""",
    "op10_warc": """WITH sized AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS size, sha1(coalesce(html, '')) AS digest FROM pages),
kept AS (
  SELECT page_id, size, digest, CASE WHEN size >= 1000 THEN max(page_id) OVER (PARTITION BY digest, size) ELSE page_id END AS largest
  FROM sized)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = largest THEN NULL ELSE largest END AS refers_to
FROM kept""",
}
