"""DuckDB SQL for the operators that SQL can express, straight from their definitions."""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = {
    "op2_substring": r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
s AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM d WHERE len(words) >= 50),
w AS (SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS h FROM s),
dup AS (
  SELECT w.doc_id, w.i FROM w JOIN (SELECT h, min(doc_id) AS source FROM w GROUP BY h) m USING (h)
  WHERE w.doc_id > m.source),
gone AS (
  SELECT doc_id, list(DISTINCT p) AS ps
  FROM (SELECT doc_id, unnest(range(i, i + 50)) AS p FROM dup) GROUP BY doc_id),
g AS (SELECT doc_id, unnest(ps) AS p FROM gone),
t AS (
  SELECT doc_id, words[p] AS word, p
  FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS p FROM d)),
k AS (
  SELECT t.doc_id, string_agg(t.word, ' ' ORDER BY t.p) AS kept
  FROM t ANTI JOIN g ON t.doc_id = g.doc_id AND t.p = g.p GROUP BY t.doc_id)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(len(gone.ps), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN gone ON d.doc_id = gone.doc_id LEFT JOIN k ON d.doc_id = k.doc_id""",
    "op4_exact": f"""
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256({LOWER}) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY {LOWER})""",
    "op5_vectors": """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (
  SELECT vec_id AS node, vec_id AS seen FROM embeddings
  UNION SELECT r.node, l.b FROM r JOIN l ON r.seen = l.a),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT c.node AS vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, c.component_id,
       c.node = c.component_id AS kept
FROM c LEFT JOIN n ON c.node = n.a""",
    "op11_suffix": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (
  SELECT doc_id, unnest(range(1, length(h) // 2 - 98)) AS i, h FROM d WHERE length(h) >= 200),
w AS (SELECT doc_id, i, md5(substr(h, 2 * i - 1, 200)) AS m FROM s),
dup AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY m ORDER BY doc_id, i) AS r FROM w) WHERE r > 1),
run AS (
  SELECT doc_id, i, coalesce(i > 100 + lag(i) OVER (PARTITION BY doc_id ORDER BY i), true) AS opens FROM dup),
span AS (
  SELECT doc_id, min(i) AS a, max(i) + 100 AS b
  FROM (SELECT doc_id, i, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM run) GROUP BY doc_id, n),
cut AS (
  SELECT doc_id, list(a ORDER BY a) AS a, list(b ORDER BY a) AS b, sum(b - a) AS gone, count(*) AS n
  FROM span GROUP BY doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN n IS NULL THEN h ELSE
         array_to_string(list_transform(range(0, n + 1), lambda k: substr(h,
           CAST(2 * (CASE WHEN k = 0 THEN 1 ELSE b[k] END) - 1 AS BIGINT),
           CAST(2 * ((CASE WHEN k = n THEN length(h) // 2 + 1 ELSE a[k + 1] END)
                     - (CASE WHEN k = 0 THEN 1 ELSE b[k] END)) AS BIGINT))), '') END)) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)""",
    "op12_divergence": r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
held AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM d)
  GROUP BY lang, term HAVING count(*) >= 10),
c AS (
  SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(terms) AS term FROM d)
  GROUP BY lang, source, term),
v AS (SELECT lang, count(*) AS v FROM held GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
kept AS (SELECT c.* FROM c JOIN held USING (lang, term)),
total AS (SELECT lang, source, sum(n) AS total FROM kept GROUP BY lang, source),
p AS (
  SELECT g.lang, g.source, held.term, coalesce(kept.n, 0) AS n,
         1 + CAST(1000000000 AS HUGEINT) * (coalesce(kept.n, 0) + 2) // (coalesce(total, 0) + 2 * v) AS p
  FROM g JOIN held ON g.lang = held.lang JOIN v ON g.lang = v.lang
  LEFT JOIN kept ON g.lang = kept.lang AND g.source = kept.source AND held.term = kept.term
  LEFT JOIN total ON g.lang = total.lang AND g.source = total.source),
q AS (
  SELECT lang, term, 1 + CAST(1000000000 AS HUGEINT) * (n + 2) // (total + 2 * v) AS q
  FROM (SELECT lang, term, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang) AS total FROM kept GROUP BY lang, term)
  JOIN v USING (lang)),
pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
    GROUP BY x.lang, x.source, y.source) x
  ON a.lang = x.lang AND a.source = x.source AND b.source = x.item),
term AS (
  SELECT p.lang, p.source, p.term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pair
  UNION ALL SELECT lang, source, 'term' AS part, item, value FROM term)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM ranked)
WHERE part = 'pair' OR rank <= 10""",
    "op13_trie": r"""
WITH steps AS (
  SELECT list_transform(range(0, 256), lambda x: list_reduce(list_concat([x], [0, 0, 0, 0, 0, 0, 0, 0]), lambda a, b:
    CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS byte_table),
own AS (
  SELECT conv_id, list(coalesce(role, '') || chr(31) || coalesce(text, '') ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (
  SELECT conv_id, turns, xor(list_reduce(list_concat([4294967295], list_transform(
    string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
    lambda a, b: xor(byte_table[CAST(xor(a, b) & 255 AS BIGINT) + 1], a >> 8)), 4294967295) % 4 AS h
  FROM own, steps),
r AS (
  SELECT h.conv_id, list_concat(coalesce(b.turns, [])[1:CAST(h AS BIGINT)],
                                h.turns[CAST(h AS BIGINT) + 1:]) AS path
  FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 20),
member AS (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS depth FROM r),
node AS (
  SELECT path[1:depth] AS key, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(path) = depth), ''))
           AS ends_sha256
  FROM member GROUP BY ALL),
kid AS (SELECT key[1:depth - 1] AS key, depth - 1 AS depth, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL),
full_node AS (
  SELECT node.*, coalesce(n_children, 0) AS n_children,
         CASE WHEN node.depth = 0 THEN 0 ELSE (n_convs - 1) * len(list_filter(regexp_split_to_array(
           substr(key[node.depth], strpos(key[node.depth], chr(31)) + 1), '[\x20\x09-\x0D]+'), lambda w: w <> '')) END AS own_saved
  FROM node LEFT JOIN kid USING (key, depth)),
up AS (
  SELECT key[1:lvl] AS key, lvl AS depth, sum(own_saved) AS saved_tokens,
         count(*) FILTER (WHERE n_children = 0) AS n_leaves
  FROM (SELECT key, n_children, own_saved, unnest(range(0, depth + 1)) AS lvl FROM full_node) GROUP BY ALL)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs,
       CAST(n.n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM full_node n JOIN up ON n.key = up.key AND n.depth = up.depth
LEFT JOIN full_node p ON p.key = n.key[1:n.depth - 1] AND p.depth = n.depth - 1""",
}
