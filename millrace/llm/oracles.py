"""DuckDB SQL for the queries of this package that SQL can express over whole tables."""

from __future__ import annotations

_PLAIN = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
f AS (SELECT body, min(page_id) AS first FROM p WHERE strlen(body) >= 100 GROUP BY body)
SELECT page_id, CAST(strlen(p.body) AS BIGINT) AS payload_bytes, sha256(p.body) AS payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
 CASE WHEN first <> page_id THEN first END AS refers_to, true AS complete FROM p LEFT JOIN f ON p.body = f.body
"""

JACCARD = rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_transform({_PLAIN}, lambda x: lower(x)) AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE c >= 0.8 * (x.n + y.n - c) - 1e-9),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT d.doc_id, (SELECT min(b) FROM r WHERE r.a = d.doc_id) AS class_id, CAST((SELECT count(*) FROM l WHERE l.a = d.doc_id) AS BIGINT) AS n_links FROM documents d
"""

LINES = rf"""
WITH w AS (SELECT doc_id, source, coalesce(text, '') AS text, {_PLAIN} AS ws FROM documents),
u AS (SELECT doc_id, k, ws[k] AS a, ws[k + 1] AS b, ws[k + 2] AS c FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS k FROM w)),
g AS (SELECT doc_id, k FROM (SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM u) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([k, k + 1, k + 2]) AS p FROM g) GROUP BY doc_id),
raw AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM w),
ln AS (SELECT *, lower(array_to_string(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> ''), ' ')) AS plain FROM raw WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM ln GROUP BY doc_id),
freq AS (SELECT source, plain FROM ln GROUP BY source, plain HAVING count(DISTINCT text) > 20),
gone AS (SELECT doc_id, sum(len(string_split(ln.plain, ' '))) AS n FROM ln JOIN freq ON ln.source = freq.source AND ln.plain = freq.plain GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
 CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(gone.n, 0) AS BIGINT) AS removed_words
 FROM w LEFT JOIN dup ON dup.doc_id = w.doc_id LEFT JOIN rep ON rep.doc_id = w.doc_id LEFT JOIN gone ON gone.doc_id = w.doc_id)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - removed_words >= 0.3 * n_words AS kept FROM m
"""


OVERLAPS = rf"""
WITH d AS (SELECT doc_id, string_split_regex(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+') AS t FROM documents),
dt AS (SELECT doc_id, unnest(t) AS tok, generate_subscripts(t, 1) - 1 AS i FROM d),
b AS (SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS t FROM benchmark),
bt AS (SELECT item_id, len(t) AS n, unnest(t) AS tok, generate_subscripts(t, 1) - 1 AS j FROM b),
m AS (SELECT doc_id, item_id, i - j AS shift, n, list(j) AS js FROM dt JOIN bt ON dt.tok = bt.tok GROUP BY doc_id, item_id, i - j, n HAVING count(*) >= least(6, n)),
v AS (SELECT DISTINCT doc_id, item_id FROM m WHERE len(list_filter(range(0, n - least(13, n) + 1), lambda s: len(list_filter(js, lambda y: y >= s AND y < s + least(13, n))) >= CASE WHEN n < 7 THEN n ELSE 0.75 * least(13, n) END)) > 0)
SELECT d.doc_id, count(v.item_id) > 0 AS contaminated, coalesce(string_agg(v.item_id, ',' ORDER BY v.item_id), '') AS items FROM d LEFT JOIN v ON d.doc_id = v.doc_id GROUP BY d.doc_id
"""

REPEATS = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, greatest(0, strlen(h) // 2 - 49))) AS p FROM d)),
f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s),
hit AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS prev FROM w JOIN f ON w.s = f.s WHERE first < doc_id),
g AS (SELECT doc_id, p, sum(CASE WHEN prev IS NULL OR p > prev + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM hit),
sp AS (SELECT doc_id, span, min(p) AS a, max(p) + 50 AS z FROM g GROUP BY doc_id, span),
seg AS (SELECT doc_id, z AS a, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS z FROM sp UNION ALL SELECT doc_id, 0, min(a) FROM sp GROUP BY doc_id),
k AS (SELECT seg.doc_id, string_agg(substr(h, 2 * a + 1, CASE WHEN z IS NULL THEN strlen(h) - 2 * a ELSE 2 * (z - a) END), '' ORDER BY a) AS k FROM seg JOIN d ON seg.doc_id = d.doc_id GROUP BY seg.doc_id),
t AS (SELECT doc_id, sum(z - a) AS removed, count(*) AS spans FROM sp GROUP BY doc_id)
SELECT d.doc_id, CAST(strlen(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN t ON d.doc_id = t.doc_id LEFT JOIN k ON d.doc_id = k.doc_id
"""

ORACLES = {"op1_warc": WARC, "op5_suffix_dedup": REPEATS, "op7_jaccard_join": JACCARD, "op9_line_rules": LINES, "op10_decontaminate": OVERLAPS}
