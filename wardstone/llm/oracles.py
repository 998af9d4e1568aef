"""SQL that DuckDB runs on the same tables, for the queries that SQL can express."""

from wardstone.llm.linerules import BOILERPLATE, FULL_STOPS, QUOTE_ENDS, QUOTE_STARTS, WIDE_CLOSERS, WIDE_SEPARATORS, WIDE_STOPS

EMBEDDINGS = """WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least AS (SELECT x, LEAST(x, MIN(y)) AS component_id FROM reach GROUP BY x),
direct AS (SELECT x, COUNT(*) AS n FROM links GROUP BY x)
SELECT vec_id, CAST(COALESCE(n, 0) AS BIGINT) AS n_links, COALESCE(component_id, vec_id) AS component_id,
  COALESCE(vec_id = COALESCE(component_id, vec_id), FALSE) AS kept
FROM embeddings LEFT JOIN least ON vec_id = least.x LEFT JOIN direct ON vec_id = direct.x"""

TOOL_CALLS = """WITH RECURSIVE asked AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user'),
answers AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'assistant'),
deep AS (
  SELECT conv_id, turn, CAST(0 AS BIGINT) AS depth FROM asked a
  WHERE NOT EXISTS (SELECT 1 FROM asked b WHERE b.conv_id = a.conv_id AND b.turn = a.turn - 2)
  UNION ALL SELECT a.conv_id, a.turn, d.depth + 1 FROM deep d JOIN asked a ON a.conv_id = d.conv_id AND a.turn = d.turn + 2),
linked AS (
  SELECT a.conv_id, a.turn, a.text, d.depth, r.turn AS result_turn, r.text AS answer, a.conv_id || ':' || a.turn AS id,
    CASE WHEN a.turn >= 2 THEN a.conv_id || ':' || (a.turn - 2) END AS after
  FROM asked a JOIN deep d ON d.conv_id = a.conv_id AND d.turn = a.turn
  LEFT JOIN answers r ON r.conv_id = a.conv_id AND r.turn = a.turn + 1)
SELECT conv_id, turn, id, 'reply' AS name, depth, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY depth, turn, id) AS position, CASE WHEN result_turn IS NULL THEN 'pending' ELSE 'linked' END AS status,
  CASE WHEN text IS NULL THEN 'missing prompt' END AS problem, result_turn, turn >= 2 AND depth = 0 AS unknown_after,
  '{"after":' || COALESCE(CAST(to_json(after) AS VARCHAR), 'null') || ',"arguments":{' ||
  CASE WHEN text IS NULL THEN '' ELSE '"prompt":' || CAST(to_json(text) AS VARCHAR) || ',' END || '"turn":' || turn ||
  '},"id":"' || id || '","name":"reply","result":' || COALESCE(CAST(to_json(answer) AS VARCHAR), 'null') || '}' AS record
FROM linked"""

_LINE_RULES = r"""WITH texts AS (SELECT doc_id, COALESCE(text, '') AS t FROM documents),
lines AS (SELECT doc_id, UNNEST(string_split(t, chr(10))) AS line, UNNEST(range(len(string_split(t, chr(10))))) AS place FROM texts),
words AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts),
windows AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, UNNEST(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3)),
twins AS (SELECT doc_id, i FROM (SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1),
repeated AS (SELECT doc_id, COUNT(DISTINCT i + k) AS n FROM twins, (VALUES (0), (1), (2)) v(k) GROUP BY doc_id),
facts AS (SELECT doc_id, place, line, w, len(w) AS n, length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
  length(line) - length(regexp_replace(line, '[A-Z]', '', 'g')) AS up, length(line) - length(regexp_replace(line, '[a-z]', '', 'g')) AS low,
  length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g')) AS symbols, length(line) - length(replace(line, '!', '')) AS bangs,
  len(list_filter(w, lambda x: x IN ('|', '>', '/', '~'))) + len(list_filter(w[2:], lambda x: x IN (WIDE_BETWEEN)))
    + GREATEST(len(list_filter(w[2:], lambda x: x IN (QUOTE_ENDS))) - (length(line) - length(regexp_replace(line, '[QUOTE_STARTS]', '', 'g'))), 0) AS separators,
  regexp_matches(line, '[.!?WIDE_STOPS]([\x20\x09-\x0D"'')\]}*_\[WIDE_CLOSERS]|$)|[FULL_STOPS]|[\x{0E00}-\x{0EFF}]') AS sentence,
  len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS again,
  ROW_NUMBER() OVER (PARTITION BY doc_id, line ORDER BY place) > 1 AS dup
  FROM (SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM lines)),
judged AS (SELECT doc_id, chars, n > 0 AND dup AS dup, n > 0 AND (separators > 0.2::DOUBLE * n OR symbols > 0.5::DOUBLE * n + 1 OR bangs > 0.5::DOUBLE * n + 1
  OR (up + low >= 20 AND up > 0.7::DOUBLE * (up + low)) OR (n >= 6 AND again > 0.5::DOUBLE * n) OR dup OR (n >= 25 AND NOT sentence)) OR BOILERPLATE AS failed FROM facts),
loss AS (SELECT doc_id, SUM(CASE WHEN failed THEN chars ELSE 0 END) AS lost, SUM(chars) AS word_chars, COUNT(*) FILTER (WHERE dup) AS dups FROM judged GROUP BY doc_id),
counted AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(dups AS BIGINT) AS n_dup_lines,
  CAST(COALESCE(repeated.n, 0) AS BIGINT) AS n_repeat_words, lost FROM words JOIN loss USING (doc_id) LEFT JOIN repeated USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost <= 0.5::DOUBLE * word_chars AS kept FROM counted"""
_SIGNS = {
    "WIDE_BETWEEN": ", ".join(f"'{c}'" for c in WIDE_SEPARATORS if c not in QUOTE_ENDS), "QUOTE_ENDS": ", ".join(f"'{c}'" for c in QUOTE_ENDS),
    "QUOTE_STARTS": QUOTE_STARTS, "WIDE_STOPS": WIDE_STOPS, "WIDE_CLOSERS": WIDE_CLOSERS, "FULL_STOPS": FULL_STOPS,
}
for _name, _text in _SIGNS.items():
    _LINE_RULES = _LINE_RULES.replace(_name, _text)
LINE_RULES = _LINE_RULES.replace("BOILERPLATE", "(" + " OR ".join(f"contains(lower(line), '{p}')" for p in BOILERPLATE) + ")")

REPEATS = """WITH t AS (SELECT doc_id, hex(encode(COALESCE(text, ''))) AS h, strlen(COALESCE(text, '')) AS n FROM documents),
windows AS (SELECT doc_id, i, md5(substr(h, CAST(2 * i + 1 AS BIGINT), 200)) AS g
  FROM (SELECT doc_id, h, UNNEST(range(n - 99)) AS i FROM t WHERE n >= 100)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, ROW_NUMBER() OVER (PARTITION BY g ORDER BY doc_id, i) AS r FROM windows) WHERE r > 1),
marked AS (SELECT doc_id, i, CASE WHEN i - LAG(i) OVER (PARTITION BY doc_id ORDER BY i) <= 100 THEN 0 ELSE 1 END AS fresh FROM again),
numbered AS (SELECT doc_id, i, SUM(fresh) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS span FROM marked),
spans AS (SELECT doc_id, MIN(i) AS b, MAX(i) + 100 AS e FROM numbered GROUP BY doc_id, span),
gaps AS (SELECT doc_id, b, e, COALESCE(LAG(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS from_ FROM spans),
cut AS (SELECT doc_id, SUM(e - b) AS removed, COUNT(*) AS spans, MAX(e) AS last,
  string_agg(substr(h, CAST(2 * from_ + 1 AS BIGINT), CAST(2 * (b - from_) AS BIGINT)), '' ORDER BY b) AS head FROM gaps JOIN t USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(COALESCE(removed, 0) AS BIGINT) AS n_removed, CAST(COALESCE(spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(COALESCE(head, '') || substr(h, CAST(2 * COALESCE(last, 0) + 1 AS BIGINT)))) AS kept_sha256
FROM t LEFT JOIN cut USING (doc_id)"""

_INTEGER_VECTORS = """kept AS MATERIALIZED (SELECT ROW_NUMBER() OVER (ORDER BY vec_id) AS r, vec_id,
  list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT c, v FROM (SELECT ROW_NUMBER() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v FROM kept) WHERE c < 16)"""
_ASSIGNED = """a{n} AS MATERIALIZED (SELECT r, vec_id, v, c, d FROM (
  SELECT r, vec_id, kept.v, c, list_dot_product(kept.v, kept.v) - 2 * list_dot_product(kept.v, m.v) + list_dot_product(m.v, m.v) AS d FROM kept, c{n} m)
  QUALIFY ROW_NUMBER() OVER (PARTITION BY r ORDER BY d, c) = 1)"""
_MOVED = """s{n} AS (SELECT c, i, CAST(SUM(CAST(x AS BIGINT)) AS BIGINT) AS s, COUNT(*) AS n
  FROM (SELECT c, UNNEST(v) AS x, UNNEST(range(64)) AS i FROM a{n}) GROUP BY c, i),
m{n} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY i) AS v FROM s{n} GROUP BY c),
c{next} AS MATERIALIZED (SELECT c, COALESCE(m{n}.v, c{n}.v) AS v FROM c{n} LEFT JOIN m{n} USING (c))"""
CLUSTERS = f"""WITH {",".join([_INTEGER_VECTORS, *(part.format(n=n, next=n + 1) for n in range(3) for part in (_ASSIGNED, _MOVED)), _ASSIGNED.format(n=3)])},
totals AS (SELECT c, CAST(SUM(d) AS BIGINT) AS cluster_inertia FROM a3 GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, cluster_inertia, (SELECT CAST(SUM(d) AS BIGINT) FROM a3) AS inertia,
  sha256(list_aggregate(list_transform(c3.v, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), 'string_agg', ',')) AS centroid_sha256
FROM a3 JOIN totals USING (c) JOIN c3 USING (c)"""

#: CRC-32 of the decimal digits of conv_id: its usual polynomial, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda g: CAST(ascii(g) AS BIGINT)),
  lambda c, b: list_reduce(range(8), lambda x, i: xor(x >> 1, (x & 1) * 3988292384), xor(c, b)), 4294967295))"""
PREFIXES = f"""WITH turns AS (SELECT conv_id, {{'r': COALESCE(role, ''), 't': COALESCE(text, '')}} AS m, ROW_NUMBER() OVER (
  PARTITION BY conv_id ORDER BY turn NULLS FIRST, COALESCE(role, ''), COALESCE(text, '')) AS pos FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(m ORDER BY pos) AS ms, CAST({_CRC32} AS BIGINT) % 6 AS h FROM turns GROUP BY conv_id),
rebuilt AS (SELECT a.conv_id, list_concat(COALESCE(b.ms[1:a.h], []), a.ms[a.h + 1:]) AS ms FROM own a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 100),
steps AS MATERIALIZED (SELECT conv_id, d, len(ms) AS n, sha256(CAST(to_json(ms[1:d]) AS VARCHAR)) AS k, sha256(CAST(to_json(ms[1:d - 1]) AS VARCHAR)) AS up,
  length(ms[d].t) AS points FROM (SELECT conv_id, ms, UNNEST(range(len(ms) + 1)) AS d FROM rebuilt)),
nodes AS MATERIALIZED (SELECT d, k, ANY_VALUE(up) AS up, MIN(conv_id) AS conv_id, COUNT(*) AS n_convs, (COUNT(*) - 1) * COALESCE(ANY_VALUE(points), 0) AS saved,
  sha256(COALESCE(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (d = n), '')) AS ends_sha256 FROM steps GROUP BY d, k),
children AS (SELECT d - 1 AS d, up AS k, COUNT(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
sums AS (SELECT s.d, s.k, SUM(saved) AS saved, COUNT(*) FILTER (c.n IS NULL) AS leaves FROM nodes u JOIN steps s ON s.conv_id = u.conv_id AND s.d <= u.d
  LEFT JOIN children c ON c.d = u.d AND c.k = u.k GROUP BY s.d, s.k)
SELECT u.conv_id, u.d AS depth, p.conv_id AS parent_conv_id, u.n_convs, COALESCE(c.n, 0) AS n_children, s.leaves AS n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, u.ends_sha256
FROM nodes u JOIN sums s USING (d, k) LEFT JOIN children c USING (d, k) LEFT JOIN nodes p ON u.d > 0 AND p.d = u.d - 1 AND p.k = u.up"""
