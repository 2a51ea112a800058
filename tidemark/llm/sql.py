"""SQL of the queries that SQL can express, over whole tables."""

from __future__ import annotations

_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(text=f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS w FROM documents WHERE doc_id IS NOT NULL),
 s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i : i + 4], ' ') END AS h FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
 p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
 l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
 e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
 r AS (SELECT doc_id AS node, doc_id AS root FROM d UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT node AS doc_id, min(root) AS component_id FROM r GROUP BY node) c USING (doc_id)"""

OP2 = f"""
WITH d AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents WHERE doc_id IS NOT NULL),
 x AS (SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
 m AS (SELECT s, min(doc_id) AS o FROM x GROUP BY s),
 r AS (SELECT DISTINCT doc_id, i + k AS j FROM (SELECT doc_id, i, unnest(range(13)) AS k FROM x JOIN m USING (s) WHERE m.o < x.doc_id)),
 g AS (SELECT doc_id, list(j) AS js FROM r GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(len(js), 0) AS n_removed, sha256(array_to_string(list_filter(w, lambda x, i: NOT coalesce(list_contains(js, i), false)), ' ')) AS kept_sha256 FROM d LEFT JOIN g USING (doc_id)"""

OP5 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents WHERE doc_id IS NOT NULL),
 b AS (SELECT doc_id, h, length(h) // 2 AS n FROM d),
 x AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS i FROM b)),
 m AS (SELECT s, min((doc_id, i)) AS o FROM x GROUP BY s HAVING count(*) > 1),
 t AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS gap FROM x JOIN m USING (s) WHERE (doc_id, i) <> m.o),
 u AS (SELECT doc_id, i, sum(CASE WHEN gap IS NULL OR gap > 100 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM t),
 v AS (SELECT doc_id, k, min(i) AS a, max(i) + 100 AS z FROM u GROUP BY doc_id, k),
 g AS (SELECT doc_id, list(a ORDER BY a) AS s, list(z ORDER BY a) AS e, sum(z - a) AS gone FROM v GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(len(s), 0) AS n_spans,
 sha256(unhex(CASE WHEN s IS NULL THEN h ELSE array_to_string(list_transform(range(0, len(s) + 1), lambda k: substr(h, CAST(2 * CASE WHEN k = 0 THEN 0 ELSE e[k] END + 1 AS BIGINT), CAST(2 * (CASE WHEN k = len(s) THEN n ELSE s[k + 1] END - CASE WHEN k = 0 THEN 0 ELSE e[k] END) AS BIGINT))), '') END)) AS kept_sha256
FROM b LEFT JOIN g USING (doc_id)"""

OP8 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages WHERE page_id IS NOT NULL),
 g AS (SELECT h, max(page_id) AS o FROM p GROUP BY h),
 q AS (SELECT *, array_to_string(list_transform(string_split(h, ''), lambda c: substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * instr('0123456789abcdef', c) - 3, 4)), '') AS bits FROM p JOIN g USING (h))
SELECT page_id, octet_length(encode(html)) AS payload_bytes,
 array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * CAST(substr(bits, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT) + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INT) + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT) + CAST(substr(bits, 5 * i + 5, 1) AS INT), 1)), '') AS payload_digest,
 CASE WHEN page_id = o THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> o THEN o END AS refers_to FROM q"""

#: crc32 is a reduction over the bytes of a text by a table of 256 numbers, made by rule; near words share what is left without one letter.
OP13 = f"""
WITH RECURSIVE t AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS tbl),
 r AS (SELECT doc_id, run, count(*) AS c FROM (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{_UPPER}', '{_LOWER}') AS run FROM documents WHERE doc_id IS NOT NULL) GROUP BY ALL),
 b AS (SELECT doc_id, run, c, hex(encode(doc_id || ':' || run)) AS x FROM r),
 h AS (SELECT run, c, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, length(x) // 2), lambda i: 16 * (instr('0123456789ABCDEF', substr(x, 2 * i + 1, 1)) - 1) + instr('0123456789ABCDEF', substr(x, 2 * i + 2, 1)) - 1)), lambda a, k: xor(tbl[(xor(a, k) & 255) + 1], a >> 8)), 4294967295) AS h FROM b, t),
 w AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM (SELECT c, CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word FROM h) WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
 k AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
 g AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest, substr(word, i, 1) AS cut FROM k),
 p AS (SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM g a JOIN g b ON a.rest = b.rest AND a.i = b.i AND a.cut <> b.cut
  UNION SELECT a.word, a.n, w.word, w.n FROM g a JOIN w ON w.word = a.rest
  UNION SELECT w.word, w.n, a.word, a.n FROM g a JOIN w ON w.word = a.rest),
 f AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS form, max(near_n) AS form_n FROM p GROUP BY word),
 m AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * w.n THEN form END AS form, CASE WHEN form_n >= 5 * w.n THEN form_n END AS form_n FROM w LEFT JOIN f USING (word)),
 c AS (SELECT word, word AS root, form AS next FROM m UNION ALL SELECT c.word, c.next, m.form FROM c JOIN m ON m.word = c.next)
SELECT m.word, m.form, c.root, m.n, m.n_near, m.form_n FROM m JOIN c ON c.word = m.word WHERE c.next IS NULL"""
