"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

_OP10 = r"""
WITH dw AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
bw AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bl AS (SELECT item_id, w, CAST(least(13, len(w)) AS BIGINT) AS m FROM bw WHERE len(w) > 0),
win AS (
  SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS g
  FROM (SELECT item_id, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i FROM bl)),
lens AS (SELECT DISTINCT m FROM win),
dwin AS (
  SELECT r, m, i, array_to_string(w[i:i + m - 1], ' ') AS g
  FROM (SELECT r, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i FROM dw, lens WHERE len(w) >= m)),
occ AS (SELECT d.r, d.i, d.m, win.item_id FROM dwin d JOIN win ON win.g = d.g AND win.m = d.m),
hit AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(generate_series(i, i + m - 1)) AS p FROM (SELECT DISTINCT r, i, m FROM occ))
  GROUP BY r),
its AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM occ) GROUP BY r),
bn AS (SELECT row_number() OVER () AS b, item_id, w, 2 * len(w) AS span, len(list_distinct(w)) AS terms FROM bl),
met AS (
  SELECT r, b, p, t, span, terms
  FROM (SELECT r, unnest(w) AS t, unnest(generate_series(1, len(w))) AS p FROM dw)
  JOIN (SELECT b, span, terms, unnest(list_distinct(w)) AS t FROM bn) USING (t)),
full_met AS (SELECT * FROM met SEMI JOIN (SELECT r, b FROM met GROUP BY r, b, terms HAVING count(DISTINCT t) = terms) USING (r, b)),
spans AS (
  SELECT r, b, terms, count(DISTINCT t) OVER (PARTITION BY r, b ORDER BY p RANGE BETWEEN CURRENT ROW AND span - 1 FOLLOWING) AS c
  FROM full_met),
near AS (
  SELECT r, count(*) AS n_near
  FROM (SELECT DISTINCT r, item_id FROM spans JOIN bn USING (b) WHERE c = spans.terms) GROUP BY r)
SELECT dw.doc_id, CAST(len(dw.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(dw.w) AS contaminated,
       CAST(coalesce(n_near, 0) AS BIGINT) AS n_near
FROM dw LEFT JOIN hit ON hit.r = dw.r LEFT JOIN its ON its.r = dw.r LEFT JOIN near ON near.r = dw.r
"""

_OP7 = r"""
WITH RECURSIVE dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 2], ' ') END AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS i FROM dw WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
same AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM sh x JOIN sh y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM same JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * c >= 85 * (p.n + q.n - c)),
link2 AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (
  SELECT doc_id AS id, doc_id AS r FROM documents
  UNION SELECT reach.id, link2.b FROM reach JOIN link2 ON link2.a = reach.r)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT id, min(r) AS c FROM reach GROUP BY id) m ON m.id = d.doc_id
"""

_OP9 = r"""
WITH good AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
bad AS (
  SELECT page_id, url, CASE WHEN coalesce(page_id, 0) % 97 = 13 THEN '~' || substr(html, 2)
                            WHEN coalesce(page_id, 0) % 1009 = 500 THEN substr(html, 1, greatest(length(html) - 1, 0))
                            ELSE html END AS html
  FROM good),
rec AS (
  SELECT side, page_id, url, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
         || 'WARC-Target-URI: ' || url || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10)
         || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10)
         || html || chr(13) || chr(10) || chr(13) || chr(10) AS r
  FROM (SELECT 1 AS side, * FROM good UNION ALL SELECT 2 AS side, * FROM bad)),
h AS (SELECT side, page_id, url, CAST(strlen(r) AS BIGINT) AS length, sha256(r) AS sha256 FROM rec),
p AS (SELECT *, row_number() OVER (PARTITION BY side ORDER BY page_id NULLS FIRST, url, sha256) - 1 AS pos FROM h),
a AS (
  SELECT *, pos // 1024 AS archive, pos % 1024 AS ordinal,
         CAST(coalesce(sum(length) OVER (PARTITION BY side, pos // 1024 ORDER BY pos
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS record_offset
  FROM p)
SELECT x.archive, x.ordinal, x.page_id, x.record_offset, x.length, 'changed' AS fault, x.sha256 AS expected_sha256,
       y.sha256 AS actual_sha256, y.record_offset AS actual_offset
FROM (SELECT * FROM a WHERE side = 1) x JOIN (SELECT * FROM a WHERE side = 2) y ON y.pos = x.pos
WHERE x.sha256 <> y.sha256
"""

_OP11 = r"""
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x
  FROM documents),
u AS (
  SELECT doc_id, t, n, CAST('0x' || substr(x, 1, 8) AS BIGINT) % (n + 1) AS c1,
         CAST('0x' || substr(x, 9, 8) AS BIGINT) % (n + 1) AS c2,
         CAST('0x' || substr(x, 17, 8) AS BIGINT) % 100 AS h3, CAST('0x' || substr(x, 25, 8) AS BIGINT) % 100 AS h4
  FROM h),
f AS (
  SELECT doc_id, t, n, least(c1, c2) AS a, greatest(c1, c2) AS b,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain'
              WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM u),
s AS (SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS suf FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM s
"""

_OP12 = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS MATERIALIZED (
  SELECT r, i, array_to_string(w[i:i + 34], ' ') AS g
  FROM (SELECT r, w, unnest(generate_series(1, len(w) - 34)) AS i FROM d WHERE len(w) >= 35)),
hit AS (SELECT r, i FROM win WHERE g IN (SELECT g FROM win GROUP BY g HAVING count(*) > 1)),
gone AS (SELECT DISTINCT r, unnest(generate_series(i, i + 34)) AS p FROM hit),
word AS (SELECT r, i AS p, w[i] AS x FROM (SELECT r, w, unnest(generate_series(1, len(w))) AS i FROM d)),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

_OP13_ROUND = r"""
n{t} AS MATERIALIZED (
  SELECT r, p, min(d * 16 + e) AS m
  FROM (SELECT r, p, e, sum((x - c) * (x - c)) AS d FROM comp JOIN b{t} USING (p, j) GROUP BY r, p, e)
  GROUP BY r, p)"""
_OP13_UPDATE = r"""
b{u} AS MATERIALIZED (
  SELECT b{t}.p, b{t}.e, b{t}.j, coalesce(f, c) AS c
  FROM b{t} LEFT JOIN (
    SELECT p, m % 16 AS e, j, CAST(floor(sum(x) / count(*)) AS BIGINT) AS f
    FROM comp JOIN n{t} USING (r, p) GROUP BY 1, 2, 3) USING (p, e, j))"""
_OP13 = r"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r, vec_id, label, v
  FROM (SELECT vec_id, label, embedding, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
comp AS MATERIALIZED (
  SELECT r, (i - 1) // (len(v) // 8) AS p, (i - 1) % (len(v) // 8) AS j, v[i] AS x
  FROM (SELECT r, v, unnest(generate_series(1, len(v))) AS i FROM kept)),
b0 AS MATERIALIZED (SELECT p, r - 1 AS e, j, x AS c FROM comp WHERE r <= 16),""" + ",".join(
    _OP13_ROUND.format(t=t) + "," + _OP13_UPDATE.format(t=t, u=t + 1) for t in range(6)) + "," + _OP13_ROUND.format(t=6) + r""",
sha AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, j)) AS h FROM b6),
code AS (
  SELECT r, string_agg(format('{:02x}', CAST(m % 16 AS INTEGER)), '' ORDER BY p) AS code,
         CAST(sum(m // 16) AS BIGINT) AS error
  FROM n6 GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM kept JOIN code USING (r), sha
"""

ORACLE_SQL: dict[str, str] = {
    "op7_circulant_minhash": _OP7,
    "op9_warc_fixity": _OP9,
    "op10_decontamination": _OP10,
    "op11_fim": _OP11,
    "op12_rlz": _OP12,
    "op13_pq": _OP13,
}
