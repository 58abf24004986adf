"""SQL of the corpus operators that SQL can express, for an engine with lists and recursive queries."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

QUALITY_RULES = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS.format(text="text")} AS ws FROM documents),
u AS (SELECT doc_id, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM d),
l AS (SELECT *, lead(a) OVER p AS b, lead(a, 2) OVER p AS c FROM u WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
x AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM l WHERE c IS NOT NULL),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM x, range(0, 3) s(k) WHERE n > 1 GROUP BY 1),
f AS (SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, length(regexp_replace(t, '[^!]', '', 'g')) AS n_marks,
  list_filter(string_split(t, chr(10)), lambda z: regexp_matches(z, '[^\x20\x09-\x0D]')) AS ls, coalesce(r.n, 0) AS n_repeat_words
  FROM d LEFT JOIN r USING (doc_id)),
g AS (SELECT *, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 100 * n_dup_lines > 30 * len(ls) OR word_chars < 2 * n_words
    OR word_chars > 20 * n_words OR 5 * n_marks > n_words) AS kept FROM g"""

NEAR_DEDUP = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS.format(text=f"translate(text, '{UPPER}', '{UPPER.lower()}')")} AS ws FROM documents),
u AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM d),
l AS (SELECT *, lead(a) OVER p AS b, lead(a, 2) OVER p AS c FROM u WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
s AS (SELECT DISTINCT doc_id, a || ' ' || b || ' ' || c AS s FROM l WHERE c IS NOT NULL
  UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM d WHERE len(ws) BETWEEN 1 AND 2),
z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN z x ON x.doc_id = a JOIN z y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN e ON e.a = r.b),
m AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, coalesce(z.n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM m LEFT JOIN z USING (doc_id)"""
