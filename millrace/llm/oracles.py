"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

ORACLES = {
    "op3_urls": r"""
WITH rules(host, path, verdict, rank) AS (VALUES
  ('com', '/', 'allow', 4), ('example.com', '/en/', 'block', 15),
  ('www.example.com', '/en/', 'allow', 19), ('net', '/es/', 'block', 7),
  ('net', '/fr/', 'block', 7)),
parsed AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
best AS (
  SELECT page_id, max_by(r.host || r.path, r.rank) AS rule, max_by(r.verdict, r.rank) AS verdict
  FROM parsed p JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY page_id)
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM parsed p LEFT JOIN best b USING (page_id)
""",
    "op5_jaccard": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[k : k + 4], ' ') AS s
  FROM words, unnest(range(1, greatest(len(w) - 3, 2))) AS t(k) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r.b) AS component_id
FROM documents d JOIN reach r ON r.a = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
GROUP BY d.doc_id
""",
    "op9_chat": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, k, CASE k WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok'
  FROM range(2) t(k)),
sized AS (
  SELECT *, length(replace(replace(role || text, '&', '&amp;'), '<', '&lt;')) + 19 AS chars
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
    AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
    FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
""",
    "op11_prefix_trie": r"""
WITH own AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id
      ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
sizes AS (
  SELECT c, count(*) AS own, c - c % 20 AS base,
    list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, _: xor(x >> 1, 3988292384 * (x & 1)))) AS inverse
  FROM own GROUP BY c),
convs AS (
  SELECT a.c, a.own, a.base, xor(a.inverse, 4294967295) % 4 AS h,
    least(xor(a.inverse, 4294967295) % 4, coalesce(b.own, 0)) AS head
  FROM sizes a LEFT JOIN sizes b ON b.c = a.base),
turns AS (
  SELECT s.c, o.pos AS depth, o.role, o.text
  FROM convs s JOIN own o ON o.c = s.base AND o.pos <= s.head
  UNION ALL
  SELECT s.c, s.head + o.pos - s.h, o.role, o.text FROM convs s JOIN own o ON o.c = s.c AND o.pos > s.h),
chained AS (
  SELECT c, depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
    sha256(array_to_string(list(sha256(role) || sha256(text)) OVER (PARTITION BY c ORDER BY depth), '')) AS name
  FROM turns),
prefixes AS (
  SELECT c, 0 AS depth, 0 AS words, '' AS name FROM convs
  UNION ALL SELECT c, depth, words, name FROM chained),
members AS (
  SELECT *, lag(name) OVER (PARTITION BY c ORDER BY depth) AS parent,
    depth = max(depth) OVER (PARTITION BY c) AS last
  FROM prefixes),
nodes AS (
  SELECT depth, name, any_value(parent) AS parent, min(c) AS c, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '')) AS ends
  FROM members GROUP BY depth, name),
children AS (SELECT depth - 1 AS depth, parent AS name, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
sums AS (
  SELECT p.depth, p.name, count(*) FILTER (k.n IS NULL) AS leaves, sum((n.n_convs - 1) * n.words) AS saved
  FROM nodes n JOIN prefixes p ON p.c = n.c AND p.depth <= n.depth
  LEFT JOIN children k ON k.depth = n.depth AND k.name = n.name
  GROUP BY p.depth, p.name)
SELECT n.c AS conv_id, n.depth, q.c AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children,
  s.leaves AS n_leaves, s.saved::BIGINT AS saved_tokens, n.ends AS ends_sha256
FROM nodes n JOIN sums s ON s.depth = n.depth AND s.name = n.name
LEFT JOIN children k ON k.depth = n.depth AND k.name = n.name
LEFT JOIN nodes q ON q.depth = n.depth - 1 AND q.name = n.parent
""",
    "op12_search": r"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
docs AS (SELECT r, doc_id, w, len(w)::BIGINT AS n FROM words WHERE len(w) > 0),
whole AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS total FROM docs),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
counts AS (
  SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM docs)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM counts, whole GROUP BY term),
parts AS (
  SELECT r, term, weights.w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // total))) AS part
  FROM counts JOIN docs USING (r) JOIN weights USING (term), whole),
scores AS (
  SELECT item_id, r, doc_id, sum(part)::BIGINT AS score
  FROM parts JOIN asked USING (term) JOIN docs USING (r) GROUP BY ALL HAVING sum(part) > 0)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores QUALIFY rank <= 10
""",
}
