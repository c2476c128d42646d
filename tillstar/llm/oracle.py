"""DuckDB SQL for those queries of this package that SQL can express on whole tables."""

from __future__ import annotations

HARD_NEGATIVES = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS nr
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
)
SELECT anchor_id, positive_id, CAST(nr AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE nr <= 3
"""

ARCHIVES = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex, strlen(coalesce(html, '')) AS n FROM pages
), d AS (
  SELECT *, max(page_id) OVER (PARTITION BY html) AS first_id,
    array_to_string(list_transform(range(0, 40, 5), lambda i:
      array_to_string(list_transform([15, 10, 5, 0], lambda b:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(hex, CAST(i AS INTEGER) + 1, 5) AS BIGINT) >> CAST(b AS BIGINT)) & 31 AS INTEGER) + 1, 1)), '')), '') AS digest
  FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to, true AS intact
FROM d
"""

CONTAMINATION = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), i AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, least(13, len(words)) AS size, array_to_string(words[p:p + least(13, len(words)) - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(words) - least(13, len(words)) + 2)) AS p FROM i WHERE len(words) > 0)
), sizes AS (SELECT DISTINCT size FROM iw),
dw AS (
  SELECT r, size, p, array_to_string(words[p:p + size - 1], ' ') AS gram
  FROM (SELECT r, words, size, unnest(range(1, len(words) - size + 2)) AS p FROM d, sizes WHERE len(words) >= size)
), hits AS (
  SELECT dw.r, dw.p, dw.size, iw.item_id FROM dw JOIN iw ON iw.size = dw.size AND iw.gram = dw.gram
), hit_words AS (
  SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(p, p + size)) AS place FROM (SELECT DISTINCT r, p, size FROM hits)) GROUP BY r
), hit_items AS (
  SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hits GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""

JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT r, doc_id, CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS shingles
  FROM w
), e AS (SELECT r, unnest(shingles) AS shingle FROM s),
shared AS (
  SELECT a.r AS x, b.r AS y, count(*) AS n FROM e a JOIN e b ON a.shingle = b.shingle AND a.r <> b.r GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN s a ON a.r = x JOIN s b ON b.r = y
  WHERE 100 * n >= 80 * (len(a.shingles) + len(b.shingles) - n)
), reach AS (
  SELECT DISTINCT x, x AS y FROM links
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, coalesce(c.component_id, s.doc_id) AS component_id
FROM s LEFT JOIN (SELECT reach.x, min(o.doc_id) AS component_id FROM reach JOIN s o ON o.r = reach.y GROUP BY reach.x) c ON c.x = s.r
"""

ORACLE_SQL: dict[str, str] = {
    "op2_warc_archives": ARCHIVES,
    "op7_decontamination": CONTAMINATION,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op12_jaccard_join": JACCARD,
}
