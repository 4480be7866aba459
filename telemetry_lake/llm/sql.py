"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

SQL: dict[str, str] = {}

SQL["op8_exact_dedup"] = rf"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{SPACE}', ' ', 'g') AS plain FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = min(doc_id) OVER g AS kept, sha256(plain) AS text_sha256
FROM d WINDOW g AS (PARTITION BY plain)
"""

SQL["op5_mixing"] = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
n AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS nth FROM s),
w AS (SELECT *, CAST([5, 2, 1][(nth - 1) % 3 + 1] AS DOUBLE) AS weight FROM n),
-- every source takes part in a trial with each number of capped sources; the first that fits holds
f AS (
  SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS all_size,
    coalesce(CAST(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS earlier,
    sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight,
    row_number() OVER o AS turn
  FROM w WINDOW o AS (ORDER BY source_size / weight, nth)),
l AS (SELECT *, (all_size * 1.5e0 - earlier * 2e0) / open_weight AS level FROM f),
c AS (SELECT arg_min(level, turn) AS level FROM l WHERE level * weight <= source_size * 2e0),
t AS (SELECT source, source_size, least(source_size * 2e0, c.level * weight) AS target FROM l, c),
r AS (
  SELECT d.*, t.source_size, t.target,
    CASE WHEN t.source_size = 0 THEN 0e0 ELSE t.target / t.source_size END AS rate,
    CAST('0x' || md5('mix-1:' || coalesce('s:' || d.source, 'null'))[1:8] AS BIGINT) / 4294967296e0 AS u,
    row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) AS rank
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(floor(rate * rank + u) - floor(rate * (rank - 1) + u) AS BIGINT) * size AS taken
FROM r
"""

SQL["op2_line_dedup"] = rf"""
WITH d AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS parts FROM documents),
p AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
x AS (
  SELECT DISTINCT doc_id, source, md5(trim(line)) AS line
  FROM (SELECT doc_id, source, unnest(parts) AS line FROM d) WHERE regexp_matches(line, '{WORD}')),
b AS (
  SELECT x.source, x.line, min(x.doc_id) AS first_page
  FROM x JOIN p ON x.source IS NOT DISTINCT FROM p.source
  GROUP BY x.source, x.line HAVING count(*) >= 5 AND count(*) > 0.02 * max(p.pages)),
g AS (
  SELECT x.doc_id, list(x.line) AS gone FROM x JOIN b
  ON x.source IS NOT DISTINCT FROM b.source AND x.line = b.line AND x.doc_id <> b.first_page GROUP BY x.doc_id),
k AS (
  SELECT d.doc_id, d.text, len(d.parts) AS n,
    CASE WHEN g.gone IS NULL THEN d.parts
      ELSE list_filter(d.parts, lambda y: NOT (regexp_matches(y, '{WORD}') AND list_contains(g.gone, md5(trim(y))))) END AS kept
  FROM d LEFT JOIN g USING (doc_id))
SELECT doc_id,
  CASE WHEN text IS NULL THEN 0 WHEN len(kept) = 0 THEN 1 ELSE len(kept) END AS n_lines,
  CAST(coalesce(n - len(kept), 0) AS BIGINT) AS dropped_lines,
  sha256(coalesce(array_to_string(kept, chr(10)), '')) AS text_sha256
FROM k
"""

RATES = {
    "word_length": ("word_chars", "n_words", 2, 0),
    "symbols": ("n_symbols", "word_chars", 4, 40),
    "shouts": ("n_shouts", "n_words", 4, 200),
    "capitals": ("n_capitals", "word_chars", 4, 150),
    "dup_lines": ("n_dup_lines", "n_lines", 4, 250),
    "repeats": ("n_repeat_words", "n_words", 4, 150),
}
STACKED = " UNION ALL ".join(f"SELECT lang, source, '{r}' AS rate, {r} AS value FROM rated WHERE NOT base_failed" for r in RATES)


def level(name: str) -> str:
    pick = ", ".join(f"max(CASE WHEN rate = '{r}' THEN q END) AS {name}_{r}" for r in RATES)
    keys = {"s": "lang, source, ", "l": "lang, ", "a": ""}[name]
    return f"""
{name}_c AS (SELECT {keys}rate, cell, sum(n) AS n FROM sketch GROUP BY ALL),
{name}_u AS (
  SELECT *, sum(n) OVER (PARTITION BY {keys}rate ORDER BY cell ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS up_to,
    sum(n) OVER (PARTITION BY {keys}rate) AS docs FROM {name}_c),
{name}_q AS (SELECT {keys}rate, max(docs) AS docs, min(cell) AS q FROM {name}_u WHERE up_to * 1000 >= docs * 500 GROUP BY ALL),
{name} AS (SELECT {keys}max(docs) AS {name}_docs, {pick} FROM {name}_q {"GROUP BY " + keys.rstrip(", ") if keys else ""})"""


BEYOND = ", ".join(
    f"CASE WHEN {r} > {m} * (CASE WHEN s_docs >= 200 THEN s_{r} WHEN l_docs >= 200 THEN l_{r} ELSE coalesce(a_{r}, 0) END) + {a} THEN '{r}' END"
    for r, (_, _, m, a) in RATES.items()
)
# The position of each window that occurs twice or more covers five words, or as many as lie before the next one.
SQL["op3_quality_rules"] = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT row, regexp_extract_all(text, '{WORD}') AS words FROM d),
g AS (
  SELECT row, i, array_to_string(words[i:i + 4], ' ') AS five
  FROM (SELECT row, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)),
t AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, five) AS n FROM g) WHERE n > 1),
v AS (
  SELECT row, CAST(sum(least(5, coalesce(following - i, 5))) AS BIGINT) AS n_repeat_words
  FROM (SELECT row, i, lead(i) OVER (PARTITION BY row ORDER BY i) AS following FROM t) GROUP BY row),
y AS (SELECT row, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines FROM d),
m AS (
  SELECT d.doc_id, d.lang, d.source, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines, len(regexp_extract_all(text, '!')) AS n_shouts,
    len(regexp_extract_all(text, '\p{{Lu}}')) AS n_capitals
  FROM d JOIN w USING (row) JOIN y USING (row) LEFT JOIN v USING (row)),
rated AS (
  SELECT *, {", ".join(f"coalesce(({p} * 1000) // nullif({q}, 0), 0) AS {r}" for r, (p, q, _, _) in RATES.items())},
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
  FROM m),
stacked AS ({STACKED}),
sketch AS (
  SELECT lang, source, rate, (value >> greatest(length(bin(value)) - 7, 0)) << greatest(length(bin(value)) - 7, 0) AS cell, count(*) AS n
  FROM stacked GROUP BY ALL),
{level("s")}, {level("l")}, {level("a")},
j AS (
  SELECT rated.*, CASE WHEN base_failed THEN 'base' ELSE concat_ws(',', {BEYOND}) END AS reason
  FROM rated LEFT JOIN s ON rated.lang IS NOT DISTINCT FROM s.lang AND rated.source IS NOT DISTINCT FROM s.source
  LEFT JOIN l ON rated.lang IS NOT DISTINCT FROM l.lang CROSS JOIN a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, reason = '' AS kept, reason FROM j
"""

SQL["op13_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256e0 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) QUALIFY rank <= 5
"""
