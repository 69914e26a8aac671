"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

CONTENT_SORT = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)"""

# windows of ten words, whole items when shorter; hit words counted one by one
DECONTAMINATION = r"""
WITH dw AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
bw AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
g AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
         unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2),
                lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) AS gram
  FROM bw WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM g),
dg AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS pos,
         unnest(list_transform(range(1, len(w) - n + 2),
                lambda i: array_to_string(w[i:i + n - 1], ' '))) AS gram
  FROM dw, sizes WHERE len(w) >= n),
hit AS (SELECT doc_id, pos, g.n, item_id FROM dg JOIN g ON dg.gram = g.gram AND dg.n = g.n),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS listed
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

# the escaped text is one backslash longer per control-like place
CHAT_FORMAT = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL
  SELECT -1, t, r, '<|im_end|><|im_start|>assistant ok'
  FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
s AS (
  SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn, role, text)
                  FILTER (role = 'assistant'), '') AS loss,
         CAST(sum(12 + length(role) + 1 + 11 + length(text)
                  + len(regexp_extract_all(text, '<\\*\|'))) AS BIGINT) AS formatted_chars
  FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars
FROM s"""

# every order is played step by step, the Shapley sums are sums over these steps
FILTER_AUDIT = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                     lambda x: x <> '') AS w FROM documents),
first AS (SELECT t, min(doc_id) AS least FROM d GROUP BY t),
f AS (
  SELECT doc_id, part,
         CASE WHEN len(w) < 50 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
         + CASE WHEN 100 * (length(d.t) - length(regexp_replace(d.t, '[A-Z]', '', 'g')))
                     > 5 * length(d.t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(d.t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN least < doc_id THEN 16 ELSE 0 END AS mask
  FROM d JOIN first ON d.t = first.t),
marks AS (SELECT doc_id, coalesce(max(quality = 1), false) AS good,
                 coalesce(max(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS g,
             count(*) FILTER (toxic) AS x
      FROM f LEFT JOIN marks USING (doc_id) GROUP BY part, mask),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(l, b)),
o AS (SELECT '' AS filter_order, 0 AS used
      UNION ALL
      SELECT filter_order || l, used + b FROM o, letters WHERE used & b = 0),
s AS (
  SELECT filter_order, step, l, b, CAST((
           SELECT coalesce(sum(e.b), 0) FROM letters e
           WHERE strpos(substr(filter_order, 1, step - 1), e.l) > 0) AS INTEGER) AS before
  FROM o, (SELECT unnest(range(1, 6)) AS step), letters
  WHERE used = 31 AND l = substr(filter_order, step, 1)),
r AS (
  SELECT part, filter_order, step, b,
         coalesce(sum(n) FILTER (mask & (before | b) = 0), 0) AS kept,
         coalesce(sum(n) FILTER (mask & before = 0 AND mask & b > 0), 0) AS removed,
         coalesce(sum(n) FILTER (mask & before > 0 AND mask & b > 0), 0) AS redundant,
         coalesce(sum(n) FILTER (mask = b), 0) AS unique_fails,
         coalesce(sum(g) FILTER (mask & before = 0 AND mask & b > 0), 0) AS good_lost,
         coalesce(sum(x) FILTER (mask & before = 0 AND mask & b > 0), 0) AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, b)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, b) AS BIGINT) AS shapley
FROM r"""

# all common shingles of all pairs, then everything reachable from each document
NGRAM_JOIN = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 2, 1) + 1),
         lambda i: array_to_string(w[i:i + 2], ' '))) AS gram
  FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
      FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * c >= 90 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION
      SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles,
       coalesce((SELECT min(b) FROM r WHERE r.a = d.doc_id), d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id)"""

HARD_NEGATIVES = r"""
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding,
                        lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor, r.vec_id AS other, a.label = r.label AS same,
         CAST(list_sum(list_transform(range(1, len(a.v) + 1),
                                      lambda i: a.v[i] * r.v[i])) AS BIGINT) AS score
  FROM r a JOIN r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor, other, score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5),
n AS (
  SELECT p.anchor, p.other AS positive, p.score AS top, s.other, s.score,
         row_number() OVER (PARTITION BY p.anchor, p.other
                            ORDER BY s.score DESC, s.other) AS rank
  FROM p JOIN s ON p.anchor = s.anchor AND NOT s.same
       AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT anchor AS anchor_id, positive AS positive_id, CAST(rank AS INTEGER) AS rank,
       other AS negative_id, top AS positive_score, score AS negative_score
FROM n WHERE rank <= 5"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_decontamination": DECONTAMINATION,
        "op8_content_sort": CONTENT_SORT,
        "op10_chat_format": CHAT_FORMAT,
        "op11_filter_audit": FILTER_AUDIT,
        "op12_ngram_join": NGRAM_JOIN,
        "op13_hard_negatives": HARD_NEGATIVES,
    }
