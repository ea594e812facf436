"""DuckDB SQL for operators whose results SQL can express: the plain definition
on whole tables, fit for small ones only."""

from __future__ import annotations

from martwright.llm import jaccard, quality

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

JACCARD = f"""
WITH RECURSIVE word AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + {jaccard.WORDS - 1}], ' ') AS s
  FROM word, unnest(range(1, greatest(1, len(w) - {jaccard.WORDS - 1}) + 1)) AS t(i) WHERE len(w) > 0),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
link AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY a, b)
  JOIN size na ON na.doc_id = a JOIN size nb ON nb.doc_id = b
  WHERE 100 * shared >= {jaccard.PERCENT} * (na.n + nb.n - shared)),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.other)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN size USING (doc_id)
"""

QUALITY = f"""
WITH doc AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
word AS (SELECT doc_id, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM doc),
window_ AS (
  SELECT doc_id, i, a, lead(a) OVER here AS b, lead(a, 2) OVER here AS c FROM word WINDOW here AS (PARTITION BY doc_id ORDER BY i)),
win AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS times FROM window_ WHERE c IS NOT NULL),
repeated AS (
  SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS pos FROM win WHERE times > 1) GROUP BY doc_id),
line AS (
  SELECT doc_id, source, text, line, len(regexp_extract_all(line, '{_WORD}')) AS words,
    trim(regexp_replace({_LOWER.format("line")}, '[ \\t-\\r]+', ' ', 'g')) AS norm
  FROM (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM doc)
  WHERE regexp_matches(line, '{_WORD}')),
twice AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM line GROUP BY doc_id),
frequent AS (
  SELECT source, norm, first FROM (SELECT source, norm, count(DISTINCT text) AS docs, min(doc_id) AS first FROM line GROUP BY source, norm)
  WHERE docs > {quality.LINE_DOCUMENTS}),
removed AS (
  SELECT doc_id, sum(words) AS n FROM line JOIN frequent f ON f.source IS NOT DISTINCT FROM line.source AND f.norm = line.norm AND doc_id <> first GROUP BY doc_id),
signal AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '{quality.SYMBOLS}'))::BIGINT AS n_symbols, coalesce(twice.n, 0)::BIGINT AS n_dup_lines,
    coalesce(repeated.n, 0)::BIGINT AS n_repeat_words, coalesce(removed.n, 0)::BIGINT AS n_removed_words
  FROM doc LEFT JOIN twice USING (doc_id) LEFT JOIN repeated USING (doc_id) LEFT JOIN removed USING (doc_id))
SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.REPEAT_PERCENT} * n_words AS base_failed,
  NOT (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.REPEAT_PERCENT} * n_words)
    AND n_words - n_removed_words >= {quality.LEFT_SHARE} * n_words AS kept
FROM signal
"""
