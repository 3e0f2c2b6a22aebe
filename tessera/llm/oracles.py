"""DuckDB SQL that says the same as queries whose method SQL can do without."""

BYTES = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS k FROM d, unnest(range(0, len(h) // 2 - 99)) t(i)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
cut AS (SELECT *, i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -1000) + 100 AS new FROM dup),
spans AS (SELECT doc_id, min(i) AS s, max(i) + 100 AS e FROM (SELECT *, sum(CAST(new AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM cut) GROUP BY doc_id, g),
bounds AS (
  SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS b FROM (
    SELECT doc_id, s, e FROM spans UNION ALL SELECT doc_id, len(h) // 2, len(h) // 2 FROM d)),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * b + 1, 2 * (s - b)), '' ORDER BY s, e) AS rest FROM bounds JOIN d USING (doc_id) GROUP BY doc_id),
gone AS (SELECT doc_id, sum(e - s) AS n, count(*) AS c FROM spans GROUP BY doc_id)
SELECT d.doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, CAST(coalesce(c, 0) AS BIGINT) AS n_spans, sha256(unhex(rest)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN gone USING (doc_id)
"""

WORDS = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS k FROM d, unnest(range(1, len(w) - 48)) t(i)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS m FROM win) WHERE doc_id > m),
gone AS (SELECT DISTINCT doc_id, i + o AS p FROM dup, range(0, 50) r(o)),
left_over AS (SELECT doc_id, p, w[p] AS x FROM d, unnest(range(1, len(w) + 1)) t(p) WHERE (doc_id, p) NOT IN (SELECT doc_id, p FROM gone)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS rest FROM left_over GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
"""

GROUPS = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_distinct([array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)]) END AS sh FROM d),
one AS (SELECT doc_id, len(sh) AS n, hash(unnest(sh)) AS x FROM s),
links AS (SELECT a.doc_id AS u, b.doc_id AS v FROM one a JOIN one b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
both_ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (SELECT doc_id AS u, doc_id AS v FROM s UNION SELECT r.u, e.v FROM reach r JOIN both_ways e ON e.u = r.v)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, min(r.v) AS component_id, s.doc_id = min(r.v) AS kept FROM s JOIN reach r ON r.u = s.doc_id GROUP BY s.doc_id, sh
"""
