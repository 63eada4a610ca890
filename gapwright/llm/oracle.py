"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from gapwright.llm import lines, spots

_WORD = "[^\\x20\\x09-\\x0D]+"

_ANCHORS = ", ".join(f"'{w}'" for w in sorted(set(spots.ANCHORS)))


def _signatures(text: str) -> str:
    words = f"list_filter(string_split_regex(lower({text}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"
    marked = f"array_to_string(list_transform({words}, lambda w: CASE WHEN w IN ({_ANCHORS}) THEN chr(2) || w ELSE w END), ' ')"
    parts = f"list_transform(string_split({marked}, chr(2)), lambda p: string_split(rtrim(p), ' '))"
    chained = f"list_transform(list_filter({parts}[2:], lambda p: len(p) > 1), lambda p: list_prepend(array_to_string(p[1:{spots.CHAIN + 1}], ' '), p[{spots.CHAIN + 2}:]))"
    found = f"list_concat(list_filter({parts}[1], lambda w: w <> ''), flatten({chained}))"
    return f"list_sort(list_distinct(list_transform(CASE WHEN len({found}) > 0 THEN {found} ELSE {words} END, lambda s: substr(md5(s), 1, 8))))"


_LIKE = "CASE WHEN len({a}) + len({b}) > 0 THEN len(list_intersect({a}, {b})) / (len({a}) + len({b}) - len(list_intersect({a}, {b})))::DOUBLE ELSE 1.0 END"

ORACLE: dict[str, str] = {
    "op5_substring": f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM p WHERE i + 12 <= len(w)),
m AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) < doc_id AS again FROM g),
c AS (SELECT p.doc_id, p.i, p.w[p.i] AS word,
  coalesce(max(again::INT) OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW), 0) AS gone
  FROM p LEFT JOIN m ON p.doc_id = m.doc_id AND p.i = m.i),
k AS (SELECT doc_id, sum(gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (gone = 0), '') AS kept FROM c GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)""",
    "op6_spots": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
n AS (SELECT doc_id, t, coalesce(lead(t) OVER (ORDER BY doc_id, t), first_value(t) OVER (ORDER BY doc_id, t)) AS u FROM d),
e AS (SELECT *, left(t, length(t) - length(t) // 2) || left(u, length(t) // 2) AS v FROM n),
s AS (SELECT *, {_signatures("t")} AS a, {_signatures("v")} AS b, {_signatures("u")} AS c FROM e)
SELECT doc_id, length(t)::BIGINT AS n_chars, sha256(v) AS edited_sha256, array_to_string(a, '') AS fingerprint, array_to_string(b, '') AS edited_fingerprint,
  {_LIKE.format(a="a", b="b")} AS near_edited, {_LIKE.format(a="a", b="c")} AS near_next
FROM s""",
    "op8_lines": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{_WORD}') AS w, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{_WORD}')) AS lines FROM d),
p AS (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) > 1 AS again FROM p),
c AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM g WHERE again) GROUP BY r),
l AS (SELECT r, doc_id, unnest(lines) AS line FROM w),
k AS (SELECT r, line, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS x, regexp_extract_all(line, '{_WORD}') AS w FROM l),
f AS (SELECT r, length(array_to_string(w, '')) AS n,
  (len(list_filter(w, lambda a: a IN ('|', '»', '›', '·', '•', '>'))) >= 2 AND len(list_filter(w, lambda a: a IN ('|', '»', '›', '·', '•', '>'))) * 6 >= len(w))
  OR len(regexp_extract_all(x, '[#*$%&|<>]')) * 12 >= length(x)
  OR (len(w) >= 5 AND NOT regexp_matches(x, '\\p{{Ll}}') AND regexp_matches(x, '\\p{{Lu}}.*\\p{{Lu}}'))
  OR (len(w) >= 8 AND len(list_distinct(w)) * 4 < len(w))
  OR regexp_matches(lower(x), '{lines.BOILERPLATE}')
  OR (len(w) < 10 AND NOT regexp_matches(x, '{lines.ENDING.replace("'", "''")}')) AS bad FROM k),
b AS (SELECT r, count(*) FILTER (bad) AS n_bad, coalesce(sum(n) FILTER (bad), 0) AS lost FROM f GROUP BY r),
s AS (SELECT w.r, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
  len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, len(lines) AS n_lines, coalesce(n_bad, 0) AS n_bad_lines, coalesce(lost, 0) AS lost
  FROM w LEFT JOIN c USING (r) LEFT JOIN b USING (r))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, n_lines::BIGINT AS n_lines, n_bad_lines::BIGINT AS n_bad_lines,
  CASE WHEN word_chars > 0 THEN lost::DOUBLE / word_chars ELSE 0.0 END AS lost,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND CASE WHEN word_chars > 0 THEN lost::DOUBLE / word_chars ELSE 0.0 END <= 0.5 AS kept
FROM s""",
    "op11_exact": r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS normal FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY normal) AS group_size, row_number() OVER w = 1 AS kept, sha256(normal) AS text_sha256
FROM t WINDOW w AS (PARTITION BY normal ORDER BY chars DESC, doc_id)""",
    "op12_divergence": r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
g AS (SELECT d.lang, d.source, coalesce(any_value(v.v), 0) AS v, coalesce(any_value(v.n), 0) AS all_n, coalesce(any_value(s.n), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM d) d LEFT JOIN v USING (lang) LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) s USING (lang, source) GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, (1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (g.n + g.v))::HUGEINT AS p,
  (1 + 1000000000::HUGEINT * (k.total + 1) // (g.all_n + g.v))::HUGEINT AS q
  FROM g JOIN kept k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
WHERE part = 'pair' OR rank <= 200""",
}
