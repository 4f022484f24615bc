"""DuckDB SQL for the queries that SQL can express."""

OP2 = r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(x, 1) AS i, UNNEST(x) AS line
  FROM (SELECT doc_id, string_split(COALESCE(text, ''), chr(10)) AS x FROM documents)),
k AS (
  SELECT doc_id, i, line,
    translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
g AS (
  SELECT key, MAX(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING COUNT(DISTINCT doc_id) >= 3),
m AS (
  SELECT k.doc_id, k.i, k.line, g.key IS NOT NULL AND k.doc_id <> g.keeper AS gone FROM k LEFT JOIN g ON k.key = g.key)
SELECT doc_id, COUNT(*) AS n_lines, CAST(SUM(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
  sha256(COALESCE(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

OP4 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS x FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(x[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, x, UNNEST(generate_series(1, GREATEST(len(x) - 3, 1))) AS i FROM w WHERE len(x) > 0)),
n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
e AS (
  SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
  WHERE 100 * common >= 80 * (x.n + y.n - common)),
r AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
c AS (SELECT a AS doc_id, MIN(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, COALESCE(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c ON c.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


# The general marks never occur: the table's roles are the template's three.
OP1 = r"""
WITH t AS (
  SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, length(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(text, chr(92), chr(92) || '0'),
      '<<SYS>>', '..'), '<</SYS>>', '..'), '[INST]', '..'), '[/INST]', '..'), '<s>', '..'), '</s>', '..'), '[ROLE]', '..'), '[TEXT]', '..'), '[/TEXT]', '..'))
    + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 ELSE 7 END AS chars,
    LAG(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
    ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS place
  FROM t),
s AS (
  SELECT *, NOT ((before IS NULL AND role IN ('system', 'user')) OR (COALESCE(before, '') IN ('system', 'assistant') AND role = 'user')
    OR (COALESCE(before, '') = 'user' AND role = 'assistant')) AS bad FROM e)
SELECT conv_id, COUNT(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(COALESCE(SUM(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(COALESCE(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(SUM(chars) AS BIGINT) AS formatted_chars,
  NOT bool_or(bad) AND arg_max(role, place) = 'assistant' AS valid, COALESCE(MIN(place) FILTER (WHERE bad), -1) AS bad_turn
FROM s GROUP BY conv_id
"""

# The words of a window in order within a stretch of its size and 3 words more: the chain goes word by word.
OP7 = r"""
WITH RECURSIVE b AS (
  SELECT item_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS x FROM benchmark),
w AS (
  SELECT DISTINCT COALESCE(CAST(item_id AS VARCHAR), '') AS item, k, array_to_string(x[i:i + k - 1], ' ') AS phrase
  FROM (SELECT item_id, x, LEAST(len(x), 10) AS k, UNNEST(generate_series(1, len(x) - LEAST(len(x), 10) + 1)) AS i FROM b WHERE len(x) > 0)),
d AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS x FROM documents),
s AS (
  SELECT doc_id, k, i, array_to_string(x[i:i + k - 1], ' ') AS phrase
  FROM (SELECT doc_id, x, k, UNNEST(generate_series(1, len(x) - k + 1)) AS i FROM d, (SELECT DISTINCT k FROM w) WHERE len(x) >= k)),
m AS (SELECT s.doc_id, s.i, s.k, w.item FROM s JOIN w ON s.k = w.k AND s.phrase = w.phrase),
h AS (SELECT doc_id, COUNT(DISTINCT p) AS n_hit FROM (SELECT doc_id, UNNEST(generate_series(i, i + k - 1)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, COUNT(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM m GROUP BY doc_id),
y AS (SELECT doc_id, UNNEST(x) AS word, generate_subscripts(x, 1) AS pos FROM d),
z AS (SELECT phrase, k, UNNEST(string_split(phrase, ' ')) AS word, generate_subscripts(string_split(phrase, ' '), 1) AS j FROM (SELECT DISTINCT phrase, k FROM w)),
c AS (
  SELECT y.doc_id, z.phrase, z.k, z.j, y.pos, y.pos AS first FROM y JOIN z ON z.j = 1 AND z.word = y.word
  UNION
  SELECT c.doc_id, c.phrase, c.k, z.j, y.pos, c.first
  FROM c JOIN (VALUES (1), (2), (3), (4)) g(gap) ON TRUE
  JOIN y ON y.doc_id = c.doc_id AND y.pos = c.pos + g.gap
  JOIN z ON z.phrase = c.phrase AND z.j = c.j + 1 AND z.word = y.word
  WHERE y.pos - c.first <= c.j + 3),
a AS (SELECT c.doc_id, COUNT(DISTINCT w.item) AS n_near_items FROM c JOIN w ON w.phrase = c.phrase WHERE c.j = c.k GROUP BY c.doc_id)
SELECT d.doc_id, CAST(len(d.x) AS BIGINT) AS n_words, COALESCE(h.n_hit, 0) AS n_hit, COALESCE(t.n_items, 0) AS n_items,
  sha256(COALESCE(t.items, '')) AS items_sha256, COALESCE(h.n_hit, 0) > 0 AS contaminated,
  COALESCE(a.n_near_items, 0) AS n_near_items
FROM d LEFT JOIN h ON h.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id LEFT JOIN a ON a.doc_id = d.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_chat_formatting": OP1, "op2_line_dedup": OP2, "op4_minhash_near_dedup": OP4, "op7_decontamination": OP7}
