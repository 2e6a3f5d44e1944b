"""SQL for the queries of this subpackage that SQL can express on whole tables."""

_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACED = r"[^\x20\x09-\x0D]+"
#: Lower-cases A-Z only.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _windows(words: str, size: str) -> str:
    return f"list_transform(range(1, CAST(greatest(len({words}) - {size} + 2, 1) AS BIGINT)), lambda i: array_to_string({words}[i:i + {size} - 1], ' '))"


OP1 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM benchmark),
bw AS (SELECT item_id, least(len(w), 10) AS m, unnest({_windows("w", "least(len(w), 10)")}) AS s FROM b WHERE len(w) > 0),
dw AS (SELECT doc_id, m, unnest({_windows("w", "m")}) AS s, generate_subscripts({_windows("w", "m")}, 1) AS i FROM d, (SELECT DISTINCT m FROM bw) WHERE len(w) >= m),
hits AS (SELECT DISTINCT dw.doc_id, dw.i, dw.m, bw.item_id FROM dw JOIN bw ON bw.m = dw.m AND bw.s = dw.s),
hit_words AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM hits, range(10) t(j) WHERE j < m GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items, sha256(coalesce(t.ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words h USING (doc_id) LEFT JOIN items t USING (doc_id)"""

OP4 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w FROM documents),
k AS (SELECT doc_id, unnest({_windows("w", "20")}) AS s, generate_subscripts({_windows("w", "20")}, 1) AS i FROM d WHERE len(w) >= 20),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS nth FROM k),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM r, range(20) t(j) WHERE nth > 1),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) FILTER (WHERE g.doc_id IS NULL) AS text, count(g.doc_id) AS n FROM words LEFT JOIN gone g USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)"""

OP8 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
sums AS (SELECT doc_id, sum(length(word)) AS chars, sum(strlen(word)) AS bytes, count(*) FILTER (WHERE regexp_matches(word, '[0-9A-Za-z]|[^\\x00-\\x7F]')) AS wordlike FROM words GROUP BY doc_id),
top AS (SELECT doc_id, max(n) AS n FROM (SELECT doc_id, word, count(*) AS n FROM words GROUP BY doc_id, word) GROUP BY doc_id),
k AS (SELECT doc_id, unnest({_windows("w", "8")}) AS s, generate_subscripts({_windows("w", "8")}, 1) AS i FROM d WHERE len(w) >= 8),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM k),
repeats AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, range(8) t(j) WHERE n > 1 GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n, count(DISTINCT line) AS kinds FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{_SPACED}') GROUP BY doc_id),
f AS (
  SELECT doc_id, len(w) AS n_words, coalesce(chars, 0) AS word_chars, length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(lines.n - kinds, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words, strlen(text) AS size, bytes, wordlike, top.n AS top, lines.n AS lines,
    length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS upper, length(text) - length(regexp_replace(text, '[A-Za-z]', '', 'g')) AS letters
  FROM d LEFT JOIN sums USING (doc_id) LEFT JOIN top USING (doc_id) LEFT JOIN repeats USING (doc_id) LEFT JOIN lines USING (doc_id)),
g AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (10 * n_symbols > size OR (10 * upper > 7 * letters AND letters > 0) OR 2 * n_dup_lines > lines
    OR NOT (bytes BETWEEN 2 * n_words AND 25 * n_words) OR 2 * wordlike < n_words OR 2 * top > n_words) AS kept
FROM g"""
