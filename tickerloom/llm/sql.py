"""Check SQL of the operators that SQL can express on whole tables, for DuckDB."""

from __future__ import annotations

_ESCAPE = "chr(27)"

CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), placed AS (
  SELECT *, lag(role, 1, '') OVER w AS before, lead(role) OVER w IS NULL AS last,
    length(text) + length(text) - length(replace(text, {_ESCAPE}, ''))
      + 2 * len(regexp_extract_all(text, '<<(TEXT|SYS|ROLE)>>|<</(SYS|ROLE)>>|\\[/?INST\\]|\\[ANS\\]|</s>'))
      + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 ELSE 9 END AS chars
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars,
  bool_and((before || '>' || role) IN ('>system', '>user', 'system>user', 'user>assistant', 'assistant>user')
    AND (NOT last OR role = 'assistant')) AS valid
FROM placed GROUP BY conv_id"""

SUBSTRINGS = """
WITH split AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') AS ws
  FROM documents
), windows AS (
  SELECT doc_id, i, sha256(array_to_string(ws[i:i + 49], ' ')) AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM split)
), owners AS (SELECT k, min(doc_id) AS owner FROM windows GROUP BY k
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS pos
  FROM windows JOIN owners USING (k) WHERE owner < doc_id
), words AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS pos, unnest(ws) AS word FROM split
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS text
  FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)"""

CONTAMINATION = """
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark
), phrase AS (
  SELECT DISTINCT item_id, size, array_to_string(ws[i:i + size - 1], ' ') AS k
  FROM (SELECT *, unnest(range(1, len(ws) - size + 2)) AS i
        FROM (SELECT *, least(13, len(ws)) AS size FROM item WHERE len(ws) > 0))
), found AS (
  SELECT doc_id, i, w.size, item_id
  FROM (SELECT doc_id, size, i, array_to_string(ws[i:i + size - 1], ' ') AS k
        FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i
              FROM doc, (SELECT DISTINCT size FROM phrase))) w
  JOIN phrase p ON p.size = w.size AND p.k = w.k
), hits AS (
  SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS pos FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(m.n, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(ws) AS contaminated
FROM doc LEFT JOIN hits h USING (doc_id) LEFT JOIN named m USING (doc_id)"""

_FINITE = "len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0"

NEGATIVES = f"""
WITH part AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND {_FINITE}
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM part a JOIN part b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""


def _round(before: str, n: int) -> str:
    """Assign the vectors to the centroids `before`, then move these (tables a<n> and c<n>)."""
    return f"""
a{n} AS (
  SELECT vec_id, q, c, d FROM (
    SELECT vec_id, q, c, xx - 2 * list_inner_product(q, m) + list_inner_product(m, m) AS d FROM kept, {before})
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1
), c{n} AS (
  SELECT c, coalesce(n.m, b.m) AS m FROM {before} b LEFT JOIN (
    SELECT c, list(v ORDER BY i) AS m
    FROM (SELECT c, i, floor(sum(q[i]) / count(*)) AS v FROM a{n}, range(1, 65) r(i) GROUP BY c, i)
    GROUP BY c) n USING (c)
)"""


CENTROIDS = f"""
WITH kept AS (
  SELECT *, list_inner_product(q, q) AS xx FROM (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS q
    FROM embeddings WHERE len(embedding) = 64 AND {_FINITE})
), c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c, q AS m FROM kept ORDER BY c LIMIT 16
), {_round("c0", 1)}, {_round("c1", 2)}, {_round("c2", 3)}, {_round("c3", 4)}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
  CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(list_transform(m, lambda x: CAST(x AS BIGINT)), ',')) AS centroid_sha256
FROM a4 JOIN c3 USING (c)"""

ORACLES = {
    "op11_hard_negatives": NEGATIVES,
    "op12_centroid_clustering": CENTROIDS,
    "op2_benchmark_decontamination": CONTAMINATION,
    "op4_chat_format": CHAT,
    "op7_substring_dedup": SUBSTRINGS,
}
