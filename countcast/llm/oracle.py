"""DuckDB SQL of the queries that SQL can express."""

from countcast.llm.hard_negatives import HIGHEST, LOWEST, N_NEGATIVES, N_POSITIVES
from countcast.llm.templates import DEPTH, LEAST_CONSTANT, LEAST_DOCUMENTS, LEAST_SHARE, LEAST_TOKENS

_LEAD = ", ".join(f"tokens[{k + 1}]" for k in range(DEPTH))

LINE_TEMPLATES = f"""
WITH keyed AS (
  SELECT row_number() OVER () AS doc, doc_id, text, string_split(text, chr(10)) AS raw FROM documents),
signed AS (
  SELECT *, list_min(list_transform(raw, lambda x: md5(x))) || list_max(list_transform(raw, lambda x: md5(x))) AS content FROM keyed),
numbered AS (
  SELECT doc, content, unnest(raw) AS raw_line, generate_subscripts(raw, 1) - 1 AS place FROM signed),
masked AS (
  SELECT doc, content, place, raw_line, regexp_replace(raw_line, '[0-9]+', '<*>', 'g') AS line,
         regexp_extract_all(regexp_replace(raw_line, '[0-9]+', '<*>', 'g'), '[^ \\x09-\\x0D]+') AS tokens FROM numbered),
lines AS (SELECT * FROM masked WHERE len(tokens) >= {LEAST_TOKENS}),
leaves AS (SELECT len(tokens) AS n, [{_LEAD}] AS lead FROM lines GROUP BY ALL HAVING count(DISTINCT content) >= {LEAST_DOCUMENTS}),
held AS (SELECT l.*, len(l.tokens) AS n, [{_LEAD}] AS lead FROM lines l
         WHERE (len(l.tokens), [{_LEAD}]) IN (SELECT (n, lead) FROM leaves)),
each AS (SELECT n, lead, line, any_value(tokens) AS tokens, count(DISTINCT content) AS contents FROM held GROUP BY n, lead, line),
parts AS (SELECT n, lead, line, contents, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS place FROM each),
constant AS (SELECT n, lead, place, token FROM parts GROUP BY ALL HAVING sum(contents) >= {LEAST_DOCUMENTS}),
templates AS (
  SELECT p.n, p.lead, p.line,
         string_agg(CASE WHEN c.token IS NULL THEN '<*>' ELSE p.token END, ' ' ORDER BY p.place) AS template
  FROM parts p LEFT JOIN constant c ON p.n = c.n AND p.lead = c.lead AND p.place = c.place AND p.token = c.token
  GROUP BY p.n, p.lead, p.line
  HAVING count(CASE WHEN c.token <> '<*>' THEN 1 END) >= {LEAST_CONSTANT} * count(*)),
found AS (SELECT h.doc, h.content, h.place, t.n, t.template FROM held h JOIN templates t ON h.n = t.n AND h.lead = t.lead AND h.line = t.line),
recurring AS (
  SELECT n, template FROM found GROUP BY n, template
  HAVING count(DISTINCT content) >= {LEAST_DOCUMENTS} AND count(DISTINCT content) >= {LEAST_SHARE} * count(DISTINCT doc)),
dropped AS (SELECT DISTINCT f.doc, f.place FROM found f JOIN recurring r ON f.n = r.n AND f.template = r.template),
kept AS (
  SELECT n.doc, string_agg(n.raw_line, chr(10) ORDER BY n.place) FILTER (d.doc IS NULL) AS text, count(*) AS n_lines, count(d.doc) AS n_dropped
  FROM numbered n LEFT JOIN dropped d ON n.doc = d.doc AND n.place = d.place GROUP BY n.doc)
SELECT k.doc_id, CASE WHEN k.text IS NULL THEN NULL ELSE coalesce(x.text, '') END AS text,
       coalesce(x.n_lines, 0) AS n_lines, coalesce(x.n_dropped, 0) AS n_dropped
FROM keyed k LEFT JOIN kept x ON k.doc = x.doc
"""

HARD_NEGATIVES = f"""
WITH used AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scored AS (
  SELECT a.row AS anchor, a.vec_id AS anchor_id, b.row AS other, b.vec_id, a.label = b.label AS same,
         CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM used a JOIN used b ON a.vec_id % 50 = 0 AND a.row <> b.row),
positives AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, other) AS positive_rank FROM scored WHERE same)
  WHERE positive_rank <= {N_POSITIVES}),
negatives AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score, p.positive_rank,
         row_number() OVER (PARTITION BY p.anchor, p.positive_rank ORDER BY n.score DESC, n.vec_id, n.other) AS rank
  FROM positives p JOIN scored n
    ON p.anchor = n.anchor AND NOT n.same AND {LOWEST} * p.score <= 100 * n.score AND 100 * n.score <= {HIGHEST} * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score,
       CAST(positive_rank AS INTEGER) AS positive_rank
FROM negatives WHERE rank <= {N_NEGATIVES}
"""

ORACLE = {"op7_line_templates": LINE_TEMPLATES, "op12_hard_negatives": HARD_NEGATIVES}
