"""DuckDB SQL for the registered queries that SQL can express over whole tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {
    "op9_exact_dedup": r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm)
""",
    "op11_filter_interaction_audit": r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
marks AS (
  SELECT doc_id, part,
         CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
  FROM texts
),
known AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
),
counters AS (
  SELECT part, mask, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, count(*) AS n
  FROM marks LEFT JOIN known USING (doc_id) GROUP BY ALL
),
letters(letter, own) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.own, b.own, c.own, d.own, e.own] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.own + b.own + c.own + d.own + e.own = 31 AND a.own | b.own | c.own | d.own | e.own = 31
),
steps AS (
  SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS earlier
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
),
counted AS (
  SELECT part, filter_order, step, own,
         sum(CASE WHEN mask & own = 0 AND mask & earlier = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & own <> 0 AND mask & earlier = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & own <> 0 AND mask & earlier <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & own <> 0 AND mask & earlier = 0 AND good = 1 THEN n ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & own <> 0 AND mask & earlier = 0 AND toxic = 1 THEN n ELSE 0 END) AS toxic_lost
  FROM counters, steps GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley
FROM counted
""",
    "op3_ngram_jaccard_join": r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM texts
),
-- equal sets are one node, named by the smallest doc_id
nodes AS (SELECT min(doc_id) AS node, list_sort(s) AS s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY list_sort(s), len(s)),
members AS (SELECT doc_id, len(sets.s) AS n_shingles, node FROM sets LEFT JOIN nodes ON list_sort(sets.s) = nodes.s),
grams AS (SELECT node, n, unnest(s) AS g FROM nodes),
pairs AS (
  SELECT a.node AS a, b.node AS b, count(*) AS common, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM grams a JOIN grams b ON a.g = b.g AND a.node < b.node AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
  GROUP BY a.node, b.node
),
links AS (SELECT a, b FROM pairs WHERE 100 * common >= 90 * (na + nb - common)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT node, node AS other FROM nodes UNION SELECT reach.node, edges.b FROM reach JOIN edges ON reach.other = edges.a),
components AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT doc_id, n_shingles, coalesce(component_id, doc_id) AS component_id FROM members LEFT JOIN components USING (node)
""",
}
