"""DuckDB SQL of the registered queries that SQL can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {WORDS} AS words FROM documents),
w AS (SELECT r, unnest(words) AS w, generate_subscripts(words, 1) AS p FROM d),
f AS (SELECT r, p, w, CAST(md5_number_lower(w) & 65535 AS BIGINT) AS h,
        lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2 FROM w WINDOW o AS (PARTITION BY r ORDER BY p)),
pairs AS (SELECT *, lead(h) OVER (PARTITION BY r ORDER BY p) AS h1 FROM f),
g AS (SELECT r, h AS g FROM pairs
      UNION ALL SELECT r, 65536 + ((h * 31 + h1) & 65535) FROM pairs WHERE h1 IS NOT NULL),
trusted AS (SELECT doc_id FROM (SELECT DISTINCT doc_id FROM labels WHERE quality = 1 AND toxic = 0)
            ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id LIMIT 50000),
t AS (SELECT r FROM d WHERE doc_id IN (SELECT doc_id FROM trusted)),
n AS (SELECT g, count(*) AS raw, count(*) FILTER (r IN (SELECT r FROM t)) AS target FROM g GROUP BY g),
s AS (SELECT sum(raw)::DOUBLE AS raw, sum(target)::DOUBLE AS target FROM n),
wt AS (SELECT n.g, CASE WHEN s.target = 0 THEN 0 ELSE
         CAST(round(ln((n.target + 10.0::DOUBLE) / (n.raw * s.target / s.raw + 10.0::DOUBLE)) * 4096) AS BIGINT) END AS weight
       FROM n, s),
score AS (SELECT r, count(*) AS n_grams, CAST(sum(weight) AS BIGINT) AS weight_sum FROM g JOIN wt USING (g) GROUP BY r),
twice AS (SELECT r, p, w2 IS NOT NULL AND count(*) OVER (PARTITION BY r, w, w1, w2) > 1 AS twice FROM f),
covered AS (SELECT r, bool_or(twice) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS c FROM twice),
rep AS (SELECT r, count(*) FILTER (c) AS n_repeat_words FROM covered GROUP BY r),
lines AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines
          FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
b AS (SELECT d.r, doc_id, CAST(len(words) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
        CAST(coalesce(n_grams, 0) AS BIGINT) AS n_grams, CAST(coalesce(weight_sum, 0) AS BIGINT) AS weight_sum
      FROM d LEFT JOIN rep USING (r) LEFT JOIN lines USING (r) LEFT JOIN score USING (r)),
j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_grams, weight_sum, base_failed,
  NOT base_failed AND weight_sum >= -328 * n_grams AS kept FROM j
"""

URLS = """
WITH rules(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
u AS (SELECT row_number() OVER () AS r, page_id,
        CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT r, page_id,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
f AS (SELECT r, rules.host || rules.path AS rule, verdict FROM p JOIN rules
      ON (p.host = rules.host OR ends_with(p.host, '.' || rules.host)) AND starts_with(p.path, rules.path)),
best AS (SELECT r, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM f GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN best USING (r)
"""

LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
LEAKS = rf"""
WITH i AS (SELECT item_id, regexp_extract_all({LOW}, '[0-9a-z[:^ascii:]]+') AS words FROM benchmark),
iw AS (SELECT DISTINCT item_id, CAST(least(len(words), 10) AS BIGINT) AS k,
         array_to_string(words[p : p + least(len(words), 10) - 1], ' ') AS w
       FROM (SELECT *, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS p FROM i WHERE len(words) > 0)),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOW}, '[0-9a-z[:^ascii:]]+') AS words FROM documents),
ks AS (SELECT DISTINCT k FROM iw),
dw AS (SELECT r, k, p, array_to_string(words[p : p + k - 1], ' ') AS w
       FROM (SELECT r, words, k, unnest(range(1, len(words) - k + 2)) AS p FROM d, ks WHERE len(words) >= k)),
h AS (SELECT r, k, p, w FROM dw WHERE (k, w) IN (SELECT (k, w) FROM iw)),
n AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(p, p + k)) AS place FROM h) GROUP BY r),
its AS (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM h JOIN iw USING (k, w)),
l AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM its GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN l USING (r)
"""

REPEATS = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS words FROM documents),
w AS (SELECT r, p, array_to_string(words[p : p + 34], ' ') AS w
      FROM (SELECT r, words, unnest(range(1, len(words) - 33)) AS p FROM d WHERE len(words) >= 35)),
t AS (SELECT w FROM w GROUP BY w HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(p, p + 35)) AS p FROM w WHERE w IN (SELECT w FROM t)),
k AS (SELECT r, list(p) AS gone FROM gone GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN words ELSE
    list_filter(words, lambda x, i: NOT list_contains(gone, i)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""

ORACLE = {
    "op1_url_filters": URLS,
    "op2_decontamination": LEAKS,
    "op5_quality_rules": QUALITY,
    "op9_substring_dedup": REPEATS,
}
