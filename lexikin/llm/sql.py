"""The SQL of the queries that SQL can express, for DuckDB."""

from __future__ import annotations

OP1 = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id,
  min(doc_id) OVER g AS keep_id,
  count(*) OVER g AS group_size,
  doc_id = min(doc_id) OVER g AS kept,
  sha256(norm) AS text_sha256
FROM t WINDOW g AS (PARTITION BY norm)
"""

OP2 = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT row, doc_id, CASE WHEN len(words) < 2 THEN words
    ELSE list_distinct([words[i] || ' ' || words[i + 1] for i in range(1, len(words))]) END AS sets
  FROM w
), c AS (
  SELECT list_sort(sets) AS sets, min(row) AS node, len(any_value(sets)) AS n FROM s WHERE len(sets) > 0 GROUP BY list_sort(sets)
), e AS (
  SELECT node, n, unnest(sets) AS shingle FROM c
), p AS (
  SELECT a.node AS lo, b.node AS hi, a.n AS x, b.n AS y, count(*) AS common
  FROM e a JOIN e b ON a.shingle = b.shingle AND a.node < b.node AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY ALL
), l AS (
  SELECT lo, hi FROM p WHERE 100 * common >= 80 * (x + y - common)
), d AS (
  SELECT lo AS a, hi AS b FROM l UNION ALL SELECT hi, lo FROM l
), r AS (
  SELECT node, node AS root FROM c
  UNION
  SELECT r.node, d.b FROM r JOIN d ON r.root = d.a
), k AS (
  SELECT s.row, s.doc_id, s.sets, c.node FROM s LEFT JOIN c ON list_sort(s.sets) = c.sets
), g AS (
  SELECT r.node, min(k.doc_id) AS component_id FROM r JOIN k ON k.node = r.root GROUP BY r.node
)
SELECT doc_id, len(sets)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id,
  doc_id = coalesce(component_id, doc_id) AS kept
FROM k LEFT JOIN g USING (node)
"""

OP9 = r"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), k AS (
  SELECT *, trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')) AS key FROM l
), spread AS (
  SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT source) >= 10
), m AS (SELECT k.*, spread.key IS NOT NULL AS gone FROM k LEFT JOIN spread USING (key))
SELECT doc_id, count(*) AS lines, count(*) FILTER (gone) AS removed_lines,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS clean_sha256
FROM m GROUP BY doc_id
"""

OP13 = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    min(doc_id) OVER (PARTITION BY text) AS first
  FROM d
), f AS (
  SELECT doc_id, part, list_value(
    len(words) < 50,
    100 * len(list_distinct(words)) < 65 * len(words),
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
    regexp_matches(text, '[#$%&*|]'),
    coalesce(first < doc_id, false)) AS fails
  FROM w
), m AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
    max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), s AS (
  SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM f LEFT JOIN m USING (doc_id) GROUP BY part, fails
), l AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), p AS (
  SELECT filter_order, step, strpos('ABCDE', filter_order[step]) AS own,
    [strpos('ABCDE', filter_order[k]) for k in range(1, step)] AS earlier
  FROM o, (SELECT unnest(range(1, 6)) AS step)
), r AS (
  SELECT part, filter_order, step, own, n, good, toxic, fails[own] AS hit, fails,
    len([k for k in earlier if fails[k]]) > 0 AS gone
  FROM s, p
), g AS (
  SELECT part, filter_order, step::INTEGER AS step, own,
    coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (hit AND NOT gone), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (hit AND gone), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (hit AND len([x for x in fails if x]) = 1), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (hit AND NOT gone), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (hit AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM r GROUP BY ALL
)
SELECT * EXCLUDE (own), (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM g
"""

ORACLES: dict[str, str] = {"op1_exact_dedup": OP1, "op2_near_dedup": OP2, "op9_line_dedup": OP9, "op13_filter_audit": OP13}
