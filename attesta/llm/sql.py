"""SQL for those operators whose results SQL can express."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

_LOW = f"translate(text, '{ascii_uppercase}', '{ascii_lowercase}')"
_WORDS = rf"coalesce(regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"

CHAT = r"""
WITH r AS (
  SELECT conv_id, turn, role AS r, text AS t FROM conversations UNION ALL
  SELECT -1, i, CASE WHEN i = 0 THEN 'user' ELSE 'assistant' END, '<|im_end|><|im_start|>assistant ok' FROM range(2) x(i)),
e AS (SELECT conv_id, turn, r, t, coalesce(r, '') AS role, coalesce(t, '') AS text FROM r)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)) AS loss_sha256,
  sum(24 + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\\\1|', 'g')) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')))::BIGINT AS formatted_chars
FROM e GROUP BY 1"""

DECONTAMINATION = f"""
WITH i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
k AS (SELECT item_id, w, least(13, len(w)) AS k FROM i WHERE len(w) > 0),
x AS (SELECT DISTINCT item_id, k, array_to_string(w[s : s + k - 1], ' ') AS key FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM k)),
d AS (SELECT doc_id, row_number() OVER () AS n, {_WORDS} AS w FROM documents),
p AS (SELECT n, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, (SELECT DISTINCT k FROM x) WHERE len(w) >= k),
h AS (SELECT n, s, p.k, item_id FROM p JOIN x ON x.k = p.k AND x.key = array_to_string(w[s : s + p.k - 1], ' ')),
c AS (SELECT n, count(DISTINCT place) AS n_hit FROM (SELECT n, unnest(range(s, s + k)) AS place FROM h) GROUP BY 1),
t AS (SELECT n, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT n, item_id::VARCHAR AS item FROM h) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (n) LEFT JOIN t USING (n)"""

JACCARD = rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(coalesce({_LOW}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM s),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
r(doc_id, reached) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.reached)
SELECT doc_id, len(s)::BIGINT AS n_shingles, m AS component_id FROM s JOIN (SELECT doc_id, min(reached) AS m FROM r GROUP BY 1) USING (doc_id)"""

RESAMPLING = f"""
WITH crc_table AS (
  SELECT list(c ORDER BY n) AS t FROM (
    SELECT n, list_reduce(list_prepend(n::BIGINT, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
    FROM range(256) r(n))),
d AS (SELECT doc_id, row_number() OVER () AS n, {_WORDS} AS w FROM documents),
b AS (SELECT unnest({_WORDS}) AS word FROM benchmark),
c AS (SELECT n, unnest(w) AS word FROM d),
own AS (SELECT n, word, count(*) AS k FROM c GROUP BY 1, 2),
h AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM own UNION SELECT DISTINCT word FROM b)),
x AS (
  SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) % 10000 AS bucket
  FROM h, crc_table),
s AS (SELECT bucket, sum(k)::DOUBLE AS s FROM own JOIN x USING (word) GROUP BY 1),
t AS (SELECT bucket, count(*)::DOUBLE AS t FROM b JOIN x USING (word) GROUP BY 1),
a AS (SELECT coalesce((SELECT sum(s) FROM s), 0) AS s_all, coalesce((SELECT sum(t) FROM t), 0) AS t_all),
g AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket), a),
v AS (SELECT n, sum(k * gain)::BIGINT AS weight FROM own JOIN x USING (word) JOIN g USING (bucket) GROUP BY 1),
r AS (
  SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN v USING (n)),
k AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place, 10 * count(*) FILTER (n_features >= 20) OVER () // 100 AS k FROM r)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= k THEN place END AS rank FROM k"""
