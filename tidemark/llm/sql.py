"""Reference SQL of the operators that SQL can express."""

from __future__ import annotations

from tidemark.llm.licenses import PHRASES, SHARE, template_words

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def text_list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def licenses_sql() -> str:
    words = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    phrases = ", ".join(f"({text_list(p.split())}, '{label}')" for p, label in PHRASES.items())
    templates = ", ".join(f"({text_list(w)}, '{label}')" for _, label, w in template_words())
    return f"""
WITH d AS (
  SELECT doc_id, {LOWER} AS t, {words.format(LOWER)} AS ws FROM documents
), phrase(p, label) AS (VALUES {phrases}), template(need, label) AS (VALUES {templates}),
places AS (
  SELECT doc_id, i - 1 AS start, label FROM d, phrase, unnest(range(1, len(ws) + 1)) AS r(i)
  WHERE ws[i] = p[1] AND ws[i : i + len(p) - 1] = p
), base AS (
  SELECT doc_id, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
         list_sort(list(DISTINCT label)) AS labels FROM places GROUP BY doc_id
), block AS (
  SELECT DISTINCT doc_id, list_distinct({words.format("line")}) AS ws
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
), met AS (
  SELECT doc_id, label, len(list_intersect(ws, need)) AS n, len(need) AS size FROM block, template
), more AS (
  SELECT doc_id, list(DISTINCT label) AS labels, max(n / size) AS share FROM met
  WHERE {SHARE[1]} * n >= {SHARE[0]} * size GROUP BY doc_id
)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
       coalesce(array_to_string(base.labels, ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(more.labels, [])))), ',') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN more USING (doc_id)
"""


PARITY_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {WORDS.format(LOWER)} AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 3], ' ') AS g
  FROM w, unnest(range(1, greatest(len(ws) - 2, 2))) AS r(i) WHERE len(ws) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), e AS (
  SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), r AS (
  SELECT doc_id AS node, doc_id AS reach FROM n UNION SELECT e.b, r.reach FROM r JOIN e ON r.node = e.a
), least AS (
  SELECT node, min(reach) AS component FROM r GROUP BY node
)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component, w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least ON node = w.doc_id
"""

PATHS_SQL = f"""
WITH w AS (
  SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS ws FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(ws[i : i + 49], ' ') AS s
  FROM w, unnest(range(1, len(ws) - 48)) AS r(i) WHERE len(ws) >= 50
), source AS (
  SELECT s, min(doc_id) AS first_doc FROM win GROUP BY s HAVING count(DISTINCT doc_id) > 1
), gone AS (
  SELECT DISTINCT doc_id, i + k AS p FROM win JOIN source USING (s), range(0, 50) AS r(k) WHERE first_doc < doc_id
), word AS (
  SELECT doc_id, i AS p, ws[i] AS word FROM w, unnest(range(1, len(ws) + 1)) AS r(i)
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS body, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
