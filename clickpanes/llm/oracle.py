"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), r AS (
  SELECT *, row_number() OVER w AS rn, first_value(doc_id) OVER w AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d
  WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, text_sha256 FROM r
"""

OP9 = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS turn
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS n FROM d GROUP BY source
), w AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM s
), l AS (
  SELECT *, (sum(n) OVER () - coalesce(sum(3 * n) OVER (ORDER BY 3 * n / weight, source NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY 3 * n / weight, source NULLS LAST
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w
), f AS (
  SELECT *, max(CASE WHEN 3 * n / weight > level THEN level END) OVER () AS top FROM l
), t AS (
  SELECT source, n, CASE WHEN 3 * n / weight <= level THEN 3.0::DOUBLE * n ELSE top * weight END AS target FROM f
), k AS (
  SELECT *, least(1.0, coalesce(min(CASE WHEN n <> target THEN target / abs(n - target) END) OVER (), 1.0))
            * (n - target) AS bend
  FROM t
), o AS (
  SELECT d.doc_id, d.size, k.n AS source_size, k.target, k.bend,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY substr(d.turn, 1, 15), d.doc_id, d.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + d.size / 2.0::DOUBLE AS middle
  FROM d JOIN k ON d.source IS NOT DISTINCT FROM k.source
)
SELECT doc_id, size, source_size, target,
       size * ((middle < target)::BIGINT + (middle + source_size < target)::BIGINT
               + (middle + 2 * source_size < target)::BIGINT) AS taken,
       CASE WHEN size > 0 AND middle < target THEN 2 * middle / (target + bend
         + sqrt(greatest(0.0, (target + bend) * (target + bend) - 4 * bend * middle))) END AS first_position
FROM o
"""

OP10 = r"""
WITH c AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations
  WHERE conv_id IS NOT NULL AND turn IS NOT NULL
), a AS (
  SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, text DESC) AS back
  FROM c WHERE role = 'assistant'
), p AS (
  SELECT x.conv_id, x.turn AS last, x.text AS last_text, y.text AS stale
  FROM a x LEFT JOIN a y ON y.conv_id = x.conv_id AND y.back = 2 WHERE x.back = 1
), r AS (
  SELECT c.conv_id, c.turn, c.role, c.text
  FROM c LEFT JOIN p ON p.conv_id = c.conv_id
  WHERE p.last IS NULL OR (c.turn, c.role, c.text) < (p.last, 'assistant', p.last_text)
  UNION
  SELECT conv_id, last, 'assistant', stale FROM p WHERE stale IS NOT NULL
), b AS (
  SELECT conv_id, turn, role, text, bool_or(side = 1) AS in_c, bool_or(side = 2) AS in_r
  FROM (SELECT *, 1 AS side FROM c UNION ALL SELECT *, 2 FROM r)
  GROUP BY conv_id, turn, role, text
), k AS (
  SELECT conv_id, turn AS t, role AS o, text AS x FROM b WHERE in_c <> in_r
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) = 1
), m AS (
  SELECT b.*, k.conv_id IS NULL OR (turn, role, text) < (t, o, x) AS shared FROM b LEFT JOIN k USING (conv_id)
), s AS (
  SELECT conv_id, 'prompt' AS part, turn, role, text FROM m WHERE shared
  UNION ALL
  SELECT conv_id, 'chosen', turn, role, text FROM m WHERE NOT shared AND in_c
  UNION ALL
  SELECT conv_id, 'rejected', turn, role, text FROM m WHERE NOT shared AND in_r
), g AS (
  SELECT *, '<|im_start|>' || role || chr(10) AS head FROM s
)
SELECT conv_id, part, turn, role, head || text || '<|im_end|>' || chr(10) AS segment,
       CASE WHEN part <> 'prompt' AND role = 'assistant' THEN length(head) END AS mask_start,
       CASE WHEN part <> 'prompt' AND role = 'assistant' THEN length(head || text || '<|im_end|>' || chr(10)) END AS mask_end
FROM g
"""

OP12 = r"""
WITH r AS (
  SELECT row_number() OVER () AS row, vec_id AS id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.row AS anchor, a.id AS anchor_id, b.id, a.label = b.label AS same,
         list_dot_product(a.q, b.q)::BIGINT AS score
  FROM r a JOIN r b ON a.row <> b.row AND len(a.q) = len(b.q)
  WHERE a.id % 100 = 0
), p AS (
  SELECT anchor, anchor_id, id, score,
         row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id NULLS LAST) AS place
  FROM s WHERE same QUALIFY place <= 5
), n AS (
  SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY s.score DESC, s.id NULLS LAST)::INTEGER AS rank
  FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

ORACLE_SQL = {
    "op1_exact_dedup": OP1,
    "op9_mix_sources": OP9,
    "op10_preference": OP10,
    "op12_hard_negatives": OP12,
}
