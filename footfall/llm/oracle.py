"""DuckDB SQL for the queries that SQL can express, written row by row."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_BLANKS = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

OP4 = f"""
WITH doc AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
item AS (SELECT item_id::varchar AS item_id, {_ALNUM} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(10, len(w)) AS n FROM item WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, n, w[k:k + n - 1] AS words
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS k FROM sized)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, k, w[k:k + n - 1] AS words
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS k FROM doc, sizes)),
hits AS (SELECT DISTINCT doc_id, k, p.n, item_id FROM places p JOIN windows v ON p.n = v.n AND p.words = v.words),
words AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(k, k + n)) AS place FROM hits) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY 1)
SELECT d.doc_id, len(d.w)::bigint AS n_words, coalesce(words.n, 0)::bigint AS n_hit, coalesce(items.n, 0)::bigint AS n_items,
  sha256(coalesce(items.ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM doc d LEFT JOIN words ON words.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
"""

OP8 = f"""
WITH RECURSIVE doc AS (SELECT doc_id, {_BLANKS} AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, w[k:k + 4] AS s
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 3, least(len(w), 1) + 1))) AS k FROM doc)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY 1),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * common.n >= 75 * (x.n + y.n - common.n)),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM doc UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
least_of AS (SELECT a, min(b) AS component FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0)::bigint AS n_shingles, component AS component_id, d.doc_id = component AS kept
FROM doc d JOIN least_of ON a = d.doc_id LEFT JOIN size ON size.doc_id = d.doc_id
"""

OP10 = """
WITH said AS (SELECT *, role IS NOT DISTINCT FROM 'assistant' AS answers FROM conversations),
named AS (
  SELECT *, conv_id::varchar || ':' || (turn - answers::int)::varchar AS call_id,
    coalesce('"prompt":' || to_json(text), '') AS prompt, coalesce('"role":' || to_json(role), '') AS spoken
  FROM said),
calls AS (SELECT call_id, min(turn) AS turn FROM named WHERE NOT answers AND call_id IS NOT NULL GROUP BY 1),
results AS (SELECT DISTINCT call_id FROM named WHERE answers AND call_id IS NOT NULL)
SELECT conv_id, n.turn, 'call' AS kind, n.call_id, r.call_id IS NOT NULL AS linked,
  ((text IS NULL)::int + (role IS NULL)::int)::bigint AS n_errors, n.turn AS order_turn, 0 AS phase,
  '{"arguments":{' || prompt || CASE WHEN text IS NOT NULL AND role IS NOT NULL THEN ',' ELSE '' END || spoken || '},"id":'
    || coalesce('"' || n.call_id || '"', 'null') || ',"kind":"call","name":"reply"}' AS json
FROM named n LEFT JOIN results r ON r.call_id = n.call_id WHERE NOT answers
UNION ALL
SELECT conv_id, n.turn, 'result', n.call_id, c.call_id IS NOT NULL, NULL, greatest(n.turn, c.turn), 1,
  '{"content":' || coalesce(to_json(text)::varchar, 'null') || ',"id":' || coalesce('"' || n.call_id || '"', 'null') || ',"kind":"result"}'
FROM named n LEFT JOIN calls c ON c.call_id = n.call_id WHERE answers
"""


OP11 = f"""
WITH doc AS (SELECT coalesce(lang, 'und') AS lang, {_LOWER} AS text FROM documents),
piece AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS text FROM doc),
line AS (SELECT lang, regexp_extract_all(text, '[^\x20\x09]+') AS w FROM piece),
total AS (SELECT lang, sum(len(w))::bigint AS n FROM line GROUP BY 1),
phrase AS (
  SELECT lang, s, array_to_string(w[k:k + s - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, s, unnest(range(1, len(w) - s + 2)) AS k FROM line, range(1, 4) AS size(s)) GROUP BY ALL),
cut AS (
  SELECT lang, phrase, s, f AS a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head,
    array_to_string(string_split(phrase, ' ')[k + 1:s], ' ') AS tail
  FROM (SELECT *, unnest(range(1, s)) AS k FROM phrase WHERE s > 1 AND f >= 10)),
scored AS (
  SELECT c.lang, c.phrase, c.a, l.f AS l, r.f AS r, ((1000000::hugeint * c.a * c.a) // (l.f::hugeint * r.f))::bigint AS score, k
  FROM cut c JOIN phrase l ON l.lang = c.lang AND l.phrase = c.head JOIN phrase r ON r.lang = c.lang AND r.phrase = c.tail),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
part AS (
  SELECT lang, array_to_string(string_split(phrase, ' ')[k:k + 1], ' ') AS phrase, max(f) AS longer
  FROM (SELECT *, unnest([1, 2]) AS k FROM phrase WHERE s = 3 AND f >= 10) GROUP BY 1, 2),
kept AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM best b LEFT JOIN part p ON p.lang = b.lang AND p.phrase = b.phrase WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM kept JOIN total USING (lang) WHERE rank <= 2000
"""

OP12 = """
WITH RECURSIVE vec AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::double) AS e FROM embeddings),
good AS (
  SELECT vec_id, e FROM vec
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a, good b
  WHERE a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach(a, b) AS (SELECT vec_id, vec_id FROM vec UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
component AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY 1),
counted AS (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY 1)
SELECT vec_id, coalesce(n, 0)::bigint AS n_links, component_id, component_id = vec_id AS kept
FROM component LEFT JOIN counted USING (vec_id)
"""

#: crc32 of a number's digits, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda x: ord(x)::bigint)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))))"""

OP13 = rf"""
WITH placed AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
conv AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {_CRC} % 4 AS h FROM (SELECT DISTINCT conv_id FROM placed)),
turns AS (
  SELECT c.conv_id, p.place, p.role, p.text FROM conv c JOIN placed p ON p.conv_id = c.base WHERE p.place <= h
  UNION ALL SELECT c.conv_id, p.place, p.role, p.text FROM conv c JOIN placed p USING (conv_id) WHERE p.place > h),
ordered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS depth FROM turns),
step AS (
  SELECT conv_id, depth, text, sha256(string_agg(sha256(role) || sha256(text), '') OVER (PARTITION BY conv_id ORDER BY depth)) AS key FROM ordered
  UNION ALL SELECT conv_id, 0, '', '' FROM conv),
own AS (SELECT conv_id, max(depth) AS length FROM step GROUP BY 1),
node AS (
  SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n, (count(*) - 1) * len(regexp_extract_all(any_value(text), '[^\x20\x09-\x0D]+')) AS saved
  FROM step GROUP BY 1, 2),
above AS (SELECT DISTINCT d.key, u.key AS up, u.depth AS up_depth, d.depth FROM step d JOIN step u ON u.conv_id = d.conv_id AND u.depth <= d.depth),
children AS (SELECT up AS key, count(*) AS n FROM above WHERE up_depth = depth - 1 GROUP BY 1),
below AS (
  SELECT up AS key, count(*) FILTER (WHERE c.n IS NULL) AS leaves, sum(node.saved) AS saved
  FROM above JOIN node USING (key) LEFT JOIN children c ON c.key = above.key GROUP BY 1),
ends AS (
  SELECT key, string_agg(conv_id::varchar, ',' ORDER BY conv_id) AS ids FROM step JOIN own USING (conv_id) WHERE depth = length GROUP BY 1)
SELECT node.conv_id, node.depth::bigint AS depth, parent.conv_id AS parent_conv_id, node.n AS n_convs, coalesce(c.n, 0)::bigint AS n_children,
  b.leaves AS n_leaves, b.saved::bigint AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM node JOIN below b USING (key) LEFT JOIN children c USING (key) LEFT JOIN ends USING (key)
LEFT JOIN above u ON u.key = node.key AND u.up_depth = node.depth - 1 LEFT JOIN node parent ON parent.key = u.up
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_benchmark_decontamination": OP4,
        "op8_minhash_near_dedup": OP8,
        "op10_chat_formatting": OP10,
        "op11_phrase_collocations": OP11,
        "op12_embedding_near_dedup": OP12,
        "op13_conversation_prefix_trie": OP13,
    }
