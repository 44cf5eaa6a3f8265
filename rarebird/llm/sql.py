"""DuckDB SQL of the queries that SQL can express, written independently of the Spark code."""

OP3 = r"""
WITH d AS (SELECT doc_id, source, len(list_filter(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size,
  md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS digest, row_number() OVER () AS r FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS n, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM d GROUP BY source),
w AS (SELECT source, n, CASE k % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS w, 2 * n AS cap FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY cap / w, k) AS i FROM (SELECT w.*, s.k FROM w JOIN s ON w.source IS NOT DISTINCT FROM s.source)),
l AS (SELECT a.i, (1.5::DOUBLE * (SELECT sum(n) FROM s)::DOUBLE - coalesce(sum(b.cap) FILTER (b.i < a.i), 0)::DOUBLE) / sum(b.w) FILTER (b.i >= a.i) AS level, any_value(a.cap / a.w) AS own
  FROM o a, o b GROUP BY a.i),
f AS (SELECT coalesce(min_by(level, i) FILTER (level < own), 1e300::DOUBLE) AS level FROM l),
t AS (SELECT source, n, least(cap::DOUBLE, level * w) AS target FROM o, f),
q AS (SELECT *, least(floor(target + 0.5)::BIGINT, 2 * n) AS x FROM t),
p AS (SELECT q.*, CASE WHEN n > 0 THEN x // n ELSE 0 END AS passes, CASE WHEN n > 0 THEN x % n ELSE 0 END AS rest FROM q),
c AS (SELECT d.*, p.n AS source_size, p.target, p.passes, p.rest,
  sum(size) OVER (PARTITION BY d.source ORDER BY digest, r ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto, size AS own FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, (size * least(2, passes + CASE WHEN rest > 0 AND upto - own < rest
  AND (upto <= rest OR upto - rest < rest - upto + own) THEN 1 ELSE 0 END))::BIGINT AS taken FROM c
"""

OP6 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_extract_all(t, '[^\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
g AS (SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM (
  SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1),
p AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM r) GROUP BY doc_id),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
  (length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')))::BIGINT AS n_symbols,
  (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(p.n, 0)::BIGINT AS n_repeat_words, len(ls) AS n_lines,
  length(t) - length(replace(t, '!', '')) AS n_shouts, length(regexp_replace(t, '[^\p{L}]+', '', 'g')) AS n_letters
  FROM w JOIN l USING (doc_id) LEFT JOIN p USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (n_words > 10000000 OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 10 * n_symbols > n_words
    OR 10 * n_dup_lines > 3 * n_lines OR 2 * n_shouts > n_words OR 2 * n_letters < word_chars) AS kept
FROM f
"""

OP9 = r"""
WITH RECURSIVE p AS (SELECT page_id, url, html, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
j AS (SELECT page_id, url, html, translate(coalesce(regexp_extract(rest, '^[^/?#]*', 0), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM p),
rules(rule, rh, rp, v) AS (VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')),
links AS (SELECT regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>', 0) AS tag, url FROM j WHERE url IS NOT NULL),
t AS (SELECT url, replace(regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1), '&amp;', '&') AS target FROM links WHERE tag <> ''),
k AS (SELECT regexp_extract(url, '^[^#]*', 0) AS a, regexp_extract(target, '^[^#]*', 0) AS b FROM t WHERE contains(target, '://')),
e AS (SELECT a, b FROM k WHERE a <> b UNION SELECT b, a FROM k WHERE a <> b),
c AS (SELECT a, a AS b FROM e UNION SELECT c.a, e.b FROM c JOIN e ON c.b = e.a),
n AS (SELECT DISTINCT b AS url, regexp_extract(substr(b, strpos(b, '://') + 3), '^[^/?#]*', 0) AS host,
  regexp_extract(substr(b, strpos(b, '://') + 3), '^[^/?#]*([^?#]*)', 1) AS path FROM c),
nr AS (SELECT n.url, arg_max(v, length(rule)) AS v FROM n JOIN rules ON (n.host = rh OR ends_with(n.host, '.' || rh)) AND starts_with(n.path, rp) GROUP BY 1),
cv AS (SELECT c.a AS url, bool_or(v = 'allow') AS al, bool_or(v = 'block') AS bl FROM c LEFT JOIN nr ON nr.url = c.b GROUP BY 1),
best AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(v, length(rule)) AS v FROM j
  JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY 1)
SELECT j.page_id, j.host, j.path, best.rule, coalesce(best.v, CASE WHEN al THEN 'allow' WHEN bl THEN 'block' END, 'allow') AS verdict
FROM j LEFT JOIN best USING (page_id) LEFT JOIN cv ON cv.url = regexp_extract(j.url, '^[^#]*', 0)
"""

# pairs of equal five-word windows at one distance form stretches; crc32 bit by bit, as DuckDB has none
OP12 = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
  xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1)))) AS h FROM documents),
e AS (SELECT doc_id, ws, len(ws) AS n, h, h // 10 AS g FROM d),
a AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM e),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
w AS (SELECT doc_id, row_number() OVER () AS r, n, CASE WHEN a IS NULL THEN ws ELSE list_transform(range(0, n), lambda i: ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS ws FROM p),
i AS (SELECT r, n, unnest(range(0, n - 4)) AS i, ws FROM w WHERE n > 5),
k AS (SELECT r, n, i, ws[i + 1 : i + 5] AS k FROM i),
x AS (SELECT u.r, u.i, v.i - u.i AS q FROM k u JOIN k v ON u.r = v.r AND u.k = v.k AND v.i > u.i AND 4 * (v.i - u.i) <= u.n),
s AS (SELECT r, q, min(i) AS s, count(*) + 4 + q AS l FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS b FROM x) GROUP BY r, q, b),
t AS (SELECT r, s, l, min(q) AS q FROM s WHERE l >= greatest(6, 4 * q) GROUP BY r, s, l),
b AS (SELECT r, count(*) AS n_runs, min_by(s, (-l, s, q)) AS start, max(l) AS length, min_by(q, (-l, s, q)) AS period,
  string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS runs, list([s + q, s + l]) AS gone FROM t GROUP BY r),
c AS (SELECT r, string_agg(word, ' ' ORDER BY j) AS kept FROM (
  SELECT w.r, unnest(ws) AS word, unnest(range(0, n)) AS j, gone FROM w JOIN b ON w.r = b.r)
  WHERE len(list_filter(gone, lambda z: z[1] <= j AND j < z[2])) = 0 GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
  (1000 * length // period)::BIGINT AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256,
  sha256(coalesce(CASE WHEN n_runs IS NULL THEN array_to_string(ws, ' ') ELSE kept END, '')) AS collapsed_sha256
FROM w LEFT JOIN b ON w.r = b.r LEFT JOIN c ON w.r = c.r
"""
