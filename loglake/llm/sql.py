"""DuckDB SQL for operators whose modules hold code that runs on executors."""

#: Exact links by counting shared shingles, components by their closure.
NEAR_DUPLICATES = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g FROM (SELECT *, unnest(range(1, greatest(len(ws) - 3, least(len(ws), 1) + 1))) AS i FROM w)
), n AS (
  SELECT doc_id, count(*) AS n, md5(string_agg(g, chr(10) ORDER BY g)) AS same FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)
), e AS (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), reach(doc_id, c) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, e.b FROM reach JOIN e ON e.a = reach.c
), least AS (
  SELECT doc_id, min(c) AS component_id FROM reach GROUP BY doc_id
), class AS (
  SELECT n.*, min(doc_id) OVER (PARTITION BY same) AS class_id FROM n
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept, coalesce(class_id, d.doc_id) AS class_id
FROM documents d JOIN least USING (doc_id) LEFT JOIN class USING (doc_id)
"""

#: First occurrences of all 100-byte windows, spans as gaps and islands.
REPEATS = r"""
WITH b AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), cut AS (
  SELECT doc_id, base, len(h) // 2 - 100 AS last, substr(h, 2 * base + 1, 600) AS piece FROM (SELECT *, unnest(range(0, len(h) // 2 - 99, 200)) AS base FROM b WHERE len(h) >= 200)
), seen AS (
  SELECT doc_id, base + j AS s, row_number() OVER (PARTITION BY md5(substr(piece, 2 * j + 1, 200)) ORDER BY doc_id, base + j) AS k
  FROM (SELECT *, unnest(range(0, least(200, last - base + 1))) AS j FROM cut)
), again AS (
  SELECT doc_id, s, max(s + 100) OVER (PARTITION BY doc_id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM seen WHERE k > 1
), spans AS (
  SELECT doc_id, min(s) AS a, max(s) + 100 AS z FROM (SELECT *, sum((reach IS NULL OR s > reach)::INT) OVER (PARTITION BY doc_id ORDER BY s) AS g FROM again) GROUP BY doc_id, g
), edges AS (
  SELECT doc_id, a, z, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM spans
), kept AS (
  SELECT doc_id, sum(z - a)::BIGINT AS n_removed, count(*)::BIGINT AS n_spans, max(z) AS last, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head FROM edges JOIN b USING (doc_id) GROUP BY doc_id
)
SELECT b.doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN last IS NULL THEN h ELSE concat(head, substr(h, 2 * last + 1)) END)) AS kept_sha256
FROM b LEFT JOIN kept USING (doc_id)
"""
