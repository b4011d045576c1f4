"""DuckDB SQL that works results out plainly: all pairs, all starts, all periods.

Meant for small tables; rows need distinct ids.
"""

from __future__ import annotations

from shelfline.llm.tries import CRC32

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORDS = r"[^\x20\x09-\x0D]+"

# Smallest node reachable from each node of links (a, b), both ways.
REACHED = """
reach AS (
  SELECT DISTINCT a AS node, a AS root FROM links
  UNION
  SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node),
labels AS (SELECT node, min(root) AS root FROM reach GROUP BY node)"""

OP2_SQL = f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS norm
  FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM vectors a JOIN vectors b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.norm > 0 AND b.norm > 0
    AND CASE WHEN len(a.e) = len(b.e) THEN list_dot_product(a.e, b.e) / (a.norm * b.norm) END >= 0.93),
{REACHED},
counted AS (SELECT a AS node, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(root, vec_id) AS component_id, vec_id = coalesce(root, vec_id) AS kept
FROM embeddings LEFT JOIN labels l ON l.node = vec_id LEFT JOIN counted c ON c.node = vec_id"""

OP10_SQL = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{WORDS}') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM worded),
posts AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS MATERIALIZED (
  SELECT p.doc_id AS a, q.doc_id AS b
  FROM posts p JOIN posts q ON p.shingle = q.shingle AND p.doc_id <> q.doc_id
  GROUP BY p.doc_id, q.doc_id, p.n, q.n HAVING 100 * count(*) >= 75 * (p.n + q.n - count(*))),
{REACHED}
SELECT doc_id, len(s) AS n_shingles, coalesce(root, doc_id) AS component_id, doc_id = coalesce(root, doc_id) AS kept
FROM sets LEFT JOIN labels ON node = doc_id"""

OP11_SQL = """
WITH bytes AS MATERIALIZED (SELECT doc_id, encode(coalesce(text, '')) AS t FROM documents),
grams AS MATERIALIZED (
  SELECT doc_id, i, md5(t[i:i + 399]) AS g
  FROM (SELECT doc_id, t, unnest(range(1, octet_length(t) - 398)) AS i FROM bytes)),
repeated AS (
  SELECT doc_id, i FROM grams SEMI JOIN (SELECT g FROM grams GROUP BY g HAVING count(*) > 1) USING (g)),
numbered AS (
  SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS span
  FROM (SELECT *, (i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -400) + 400)::INT AS fresh FROM repeated)),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 400 AS b FROM numbered GROUP BY doc_id, span),
gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 1) AS a, a AS b FROM spans
  UNION ALL
  SELECT doc_id, coalesce(max(b), 1), max(octet_length(t)) + 1 FROM bytes LEFT JOIN spans USING (doc_id) GROUP BY doc_id),
rest AS (
  SELECT doc_id, sha256(unhex(string_agg(CASE WHEN a < b THEN hex(t[a:b - 1]) ELSE '' END, '' ORDER BY a))) AS kept_sha256
  FROM gaps JOIN bytes USING (doc_id) GROUP BY doc_id),
removed AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, octet_length(t)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, kept_sha256
FROM bytes JOIN rest USING (doc_id) LEFT JOIN removed USING (doc_id)"""

# Stretches of words that equal the word q further on; of equal stretches the least q is the smallest period.
OP13_SQL = rf"""
WITH hashed AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w, xor({CRC32.replace("conv_id", "doc_id")}, 4294967295) AS h
  FROM documents),
measured AS (SELECT *, len(w) AS n, (h // 10) % nullif(len(w), 0) AS a, 3 + (h // 10) % 8 AS parts FROM hashed),
planted AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // parts) END]) ELSE w END AS w
  FROM measured),
words AS MATERIALIZED (SELECT doc_id, n, unnest(range(n)) AS i, unnest(w) AS x FROM planted),
again AS (
  SELECT a.doc_id, b.i - a.i AS q, a.i
  FROM words a JOIN words b ON a.doc_id = b.doc_id AND a.x = b.x AND b.i > a.i AND b.i <= a.i + a.n // 4),
stretches AS (
  SELECT doc_id, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS r FROM again)
  GROUP BY doc_id, q, r HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS MATERIALIZED (SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length),
dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS text FROM words ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
    first({{'s': start, 'l': length, 'p': period}} ORDER BY length::DOUBLE / period DESC, start, period) AS best
  FROM runs GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.p AS period,
  1000 * best.l // best.p AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM planted LEFT JOIN listed USING (doc_id) LEFT JOIN kept k USING (doc_id)"""
