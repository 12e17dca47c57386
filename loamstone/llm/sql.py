"""DuckDB statements beside the llm queries; given where SQL states the whole definition and runs over whole tables."""

from __future__ import annotations

SQL = {
    "p2_found": r"""
WITH cut AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents
), bare AS (
  SELECT doc_id, source, line_no,
    trim(regexp_replace(regexp_replace(lower(line), '[^\p{L}\p{M}\s\p{Z}\x{85}]+', '', 'g'), '[\s\p{Z}\x{85}]+', ' ', 'g')) AS words FROM cut
), keyed AS (
  SELECT doc_id, source, line_no, replace(words, ' ', '') AS k FROM bare WHERE length(words) - length(replace(words, ' ', '')) >= 2
), n AS (SELECT source, count(*) AS docs FROM documents GROUP BY source),
f AS (SELECT source, k, count(DISTINCT doc_id) AS df FROM keyed GROUP BY source, k)
SELECT keyed.doc_id AS doc_id, CAST(keyed.line_no AS INTEGER) AS line_no
FROM keyed JOIN f ON keyed.source IS NOT DISTINCT FROM f.source AND keyed.k = f.k JOIN n ON n.source IS NOT DISTINCT FROM f.source
WHERE f.df >= 3 AND f.df * 10 >= n.docs
""",
    "p7_found": r"""
WITH t AS (SELECT DISTINCT id, text FROM redteam_adversarial WHERE id IS NOT NULL AND text IS NOT NULL),
w AS (SELECT id, text, regexp_extract_all(lower(text), '[\p{L}]+[\p{M}\p{L}]*') AS w FROM t),
g AS (SELECT id, text, w, unnest(range(1, len(w) - 3)) AS pos FROM w WHERE len(w) >= 5),
k AS (SELECT id, text, pos, row_number() OVER (PARTITION BY id, text, array_to_string(w[pos:pos+4], ' ') ORDER BY pos) AS nth FROM g),
m AS (SELECT DISTINCT id, text, pos + j AS pos FROM (SELECT id, text, pos, unnest([0, 1, 2, 3, 4]) AS j FROM k WHERE nth > 1)),
r AS (SELECT w.id, w.text, sum(length(w.w[m.pos])) AS again FROM m JOIN w ON m.id = w.id AND m.text = w.text GROUP BY 1, 2)
SELECT DISTINCT r.id FROM r JOIN w ON r.id = w.id AND r.text = w.text WHERE again >= 0.4 * list_sum(list_transform(w.w, lambda x: length(x)))
""",
    "p9_found": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
i AS (SELECT item_id, regexp_extract_all(lower(passage), '[\p{L}\p{M}\p{N}]+') AS w FROM eval_items WHERE passage IS NOT NULL),
p AS (SELECT DISTINCT item_id, array_to_string(w[pos:pos+12], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS pos FROM i WHERE len(w) >= 13)),
q AS (SELECT doc_id, array_to_string(w[pos:pos+12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS pos FROM d WHERE len(w) >= 13))
SELECT DISTINCT doc_id, item_id FROM q JOIN p ON q.g = p.g
""",
}
