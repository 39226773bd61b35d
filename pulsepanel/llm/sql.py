"""SQL forms of the queries that SQL can express, for DuckDB."""

SQL: dict[str, str] = {}

SQL["op8_winnowing"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
iw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS run
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS run
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM iw))),
m AS (SELECT doc_id, p, iw.n AS n, item_id FROM dw JOIN iw ON dw.run = iw.run AND dw.n = iw.n),
h AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM m) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""

# lines are hashed in the query and compared whole here
SQL["op9_line_frequency"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce('=' || source, '') AS host FROM documents),
w AS (SELECT doc_id, text, host, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, string_split(text, chr(10)) AS l FROM d),
b AS (
  SELECT doc_id, text, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols
  FROM w),
r AS (
  SELECT doc_id, text, count(DISTINCT p + k) AS n_repeat_words
  FROM (SELECT doc_id, text, p, count(*) OVER (PARTITION BY doc_id, text, g) AS uses
        FROM (SELECT doc_id, text, p, array_to_string(w[p:p + 2], ' ') AS g
              FROM (SELECT DISTINCT doc_id, text, w, unnest(range(1, greatest(len(w) - 1, 1))) AS p FROM w))), range(3) AS t(k)
  WHERE uses > 1 GROUP BY 1, 2),
l AS (SELECT doc_id, text, host, line FROM (SELECT doc_id, text, host, unnest(l) AS line FROM w)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, text, CAST(count(*) - count(DISTINCT line) AS BIGINT) AS n_dup_lines FROM l GROUP BY 1, 2),
nl AS (SELECT doc_id, text, host, line, CAST(length(line) - length(replace(line, ' ', '')) + 1 AS BIGINT) AS n
       FROM (SELECT DISTINCT doc_id, text, host, lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'), ' ')) AS line FROM l)),
f AS (SELECT host, line FROM nl GROUP BY 1, 2 HAVING count(DISTINCT (doc_id, text)) > 20),
x AS (SELECT doc_id, text, CAST(sum(n) AS BIGINT) AS line_words,
             CAST(sum(CASE WHEN f.line IS NOT NULL THEN n ELSE 0 END) AS BIGINT) AS frequent_words
      FROM nl LEFT JOIN f USING (host, line) GROUP BY 1, 2),
a AS (
  SELECT b.*, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(line_words, 0) AS line_words, coalesce(frequent_words, 0) AS n_frequent_words
  FROM b LEFT JOIN r USING (doc_id, text) LEFT JOIN dup USING (doc_id, text) LEFT JOIN x USING (doc_id, text))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_frequent_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND 100 * (line_words - n_frequent_words) >= 30 * line_words AS kept
FROM a
"""

# 11: the characters of the template around role and text
SQL["op6_chat_event_log"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(11 + length(regexp_replace(role || text, '([\\<\[\]])', '\\\1', 'g'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""

# phrases as lists of words; products in 128 bits
SQL["op13_phrase_index"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
g AS (
  SELECT lang, w[p:p + k - 1] AS g, k, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k))
  GROUP BY ALL HAVING count(*) >= 100 OR k = 1),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE k = 1 GROUP BY 1),
c AS (SELECT lang, g, k, f FROM g WHERE k > 1),
inside AS (
  SELECT DISTINCT c.lang, s.g FROM c, (SELECT unnest([2, 3, 4]) AS size) AS z, LATERAL (
    SELECT unnest([c.g[p:p + size - 1] FOR p IN range(1, c.k - size + 2)]) AS g) AS s
  JOIN c AS short ON short.lang = c.lang AND short.g = s.g
  WHERE size < c.k AND 100 * c.f >= 100 * short.f),
cuts AS (
  SELECT c.lang, c.g, c.f AS a, cut, c.g[:cut] AS x, c.g[cut + 1:] AS y
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) AS c ANTI JOIN inside USING (lang, g)),
scored AS (
  SELECT q.lang, array_to_string(q.g, ' ') AS phrase, a, l.f AS l, r.f AS r, n, cut,
         CAST((1000 * CAST(a AS HUGEINT) * n) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM cuts AS q JOIN g AS l ON l.lang = q.lang AND l.g = x JOIN g AS r ON r.lang = q.lang AND r.g = y JOIN n ON n.lang = q.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
"""

# crc32 bit by bit; a node is the MD5s of its turns, one after the other
SQL["op12_prefix_trie"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, length(coalesce(text, '')) AS chars,
         md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS key
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list({'key': key, 'chars': chars} ORDER BY turn NULLS FIRST, role, key) AS turns FROM t GROUP BY 1),
h AS (
  SELECT *, conv_id - conv_id % 100 AS base, xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END))) % 6 AS head
  FROM o),
r AS (
  SELECT h.conv_id, list_concat(coalesce(b.turns[:head], []), h.turns[head + 1:]) AS turns
  FROM h LEFT JOIN o AS b ON b.conv_id = h.base),
p AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM r),
n AS (
  SELECT array_to_string([x.key FOR x IN turns[:depth]], '') AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         any_value(coalesce(turns[depth].chars, 0)) AS chars,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(turns) = depth), '')) AS ends_sha256
  FROM p GROUP BY 1, 2),
c AS (SELECT left(node, 32 * (depth - 1)) AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
k AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN c USING (node)),
s AS (
  SELECT left(node, 32 * j) AS node, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * chars) AS saved
  FROM (SELECT *, unnest(range(0, depth + 1)) AS j FROM k) GROUP BY 1)
SELECT k.conv_id, k.depth, up.conv_id AS parent_conv_id, k.n_convs, k.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, k.ends_sha256
FROM k JOIN s USING (node) LEFT JOIN k AS up ON k.depth > 0 AND up.node = left(k.node, 32 * (k.depth - 1))
"""
