"""SQL of the queries that SQL can express."""

from __future__ import annotations

WORDS = r"len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))"

OP4 = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
pairs AS (
  SELECT doc_id, text, length(text) AS n,
         coalesce(lead(text) OVER (ORDER BY doc_id NULLS FIRST), first(text) OVER (ORDER BY doc_id NULLS FIRST)) AS next
  FROM texts),
edits AS (
  SELECT row_number() OVER () AS id, doc_id, n, text, next,
         substr(text, 1, n - n // 4) || substr(next, 1, n // 4) AS edited
  FROM pairs),
forms AS (
  SELECT id, unnest([1, 2, 3]) AS which, unnest([text, edited, next]) AS t FROM edits),
parted AS (
  SELECT id, which,
    list_transform(string_split(t, chr(10) || chr(10)), lambda s: list_transform(string_split(s, chr(10)),
      lambda p: list_transform(string_split(p, '. '), lambda x: CASE WHEN length(x) > 64
        THEN regexp_extract_all(x, '(?s).{16,62}?(?:[dnrty!?;:,] |[。！？])|.{1,64}') ELSE [x] END))) AS parts
  FROM forms),
roots AS (
  SELECT id, which, sha256(array_to_string(list_transform(parts, lambda s: sha256(array_to_string(list_transform(s, lambda p:
    sha256(array_to_string(list_transform(p, lambda x: sha256(array_to_string(list_transform(x, lambda y: sha256(y)), ','))), ','))), ','))), ',')) AS root
  FROM parted),
leaves AS (
  SELECT id, which, leaf, count(*) AS c, length(leaf) + 1 AS w
  FROM (SELECT id, which, unnest(flatten(flatten(flatten(parts)))) AS leaf FROM parted) GROUP BY 1, 2, 3, 5),
weights AS (SELECT id, which, sum(c * w) AS total FROM leaves GROUP BY 1, 2),
shared AS (
  SELECT a.id, b.which, sum(least(a.c, b.c) * a.w) AS common
  FROM leaves a JOIN leaves b ON a.id = b.id AND a.leaf = b.leaf WHERE a.which = 1 AND b.which > 1 GROUP BY 1, 2),
alike AS (
  SELECT r.id, r.which, CASE WHEN r.root = o.root THEN 1.0::DOUBLE
    ELSE coalesce(s.common, 0)::DOUBLE / (w.total + v.total - coalesce(s.common, 0))::DOUBLE END AS near
  FROM roots r JOIN roots o ON o.id = r.id AND o.which = 1 JOIN weights w ON w.id = r.id AND w.which = r.which
    JOIN weights v ON v.id = r.id AND v.which = 1 LEFT JOIN shared s ON s.id = r.id AND s.which = r.which)
SELECT e.doc_id, e.n AS n_chars, sha256(e.edited) AS edited_sha256, o.root AS fingerprint, c.root AS edited_fingerprint,
       x.near AS near_edited, y.near AS near_next
FROM edits e JOIN roots o ON o.id = e.id AND o.which = 1 JOIN roots c ON c.id = e.id AND c.which = 2
  JOIN alike x ON x.id = e.id AND x.which = 2 JOIN alike y ON y.id = e.id AND y.which = 3
"""

OP6 = rf"""
WITH sized AS (
  SELECT doc_id, source, text, coalesce({WORDS}, 0)::BIGINT AS size FROM documents),
per_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM per_source),
weighed AS (
  SELECT *, ([3.0, 1.0, 2.0])[(rank % 3 + 1)::INT]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS most FROM ranked),
levels AS (
  SELECT *, most / weight AS ratio,
         ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
           - coalesce(sum(most) OVER (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / (sum(weight) OVER ()
           - coalesce(sum(weight) OVER (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM weighed),
stop AS (SELECT level FROM levels WHERE ratio > level ORDER BY ratio, rank LIMIT 1),
goals AS (
  SELECT source, source_size,
         CASE WHEN (SELECT level FROM stop) IS NULL THEN most
              ELSE least(most, weight * (SELECT level FROM stop)) END AS target
  FROM levels),
drawn AS (
  SELECT d.doc_id, d.size, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0 END AS rate,
         ('0x' || substr(md5(concat_ws(':', '0', d.doc_id, d.text)), 1, 10))::BIGINT::DOUBLE / 1099511627776.0::DOUBLE AS draw
  FROM sized d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate)::BIGINT + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM drawn
"""

OP12 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([1 FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = v.label AS alike, v.vec_id AS other_id,
    CAST(list_sum([p[1] * p[2] FOR p IN list_zip(a.x, v.x)]) AS BIGINT) AS score
  FROM v a, v WHERE a.vec_id % 50 = 0 AND a.vec_id <> v.vec_id AND len(a.x) = len(v.x)),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id
WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) <= 3
"""

ORACLE = {
    "op4_document_fingerprints": OP4,
    "op6_mixing": OP6,
    "op12_hard_negatives": OP12,
}
