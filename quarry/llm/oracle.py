"""DuckDB SQL for the ``opN_*`` queries that SQL can express."""

from __future__ import annotations

SQL: dict[str, str] = {}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL["op4_decontaminate"] = rf"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ITEM_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
pat AS (SELECT DISTINCT item, len(win) AS m, array_to_string(win, ' ') AS p FROM (
  SELECT item, list_slice(w, s, s + 9) AS win
  FROM b, LATERAL (SELECT unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s) WHERE len(w) > 0)),
d AS (SELECT doc_id, coalesce({_ITEM_WORDS}, []) AS w FROM documents),
lens AS (SELECT DISTINCT m FROM pat),
win AS (SELECT doc_id, s, m, array_to_string(list_slice(w, s, s + m - 1), ' ') AS p
  FROM d, lens, LATERAL (SELECT unnest(range(1, len(w) - m + 2)) AS s)),
occ AS (SELECT doc_id, s, win.m, item FROM win JOIN pat ON pat.p = win.p AND pat.m = win.m),
hit AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (
  SELECT doc_id, unnest(range(s, s + m)) AS x FROM (SELECT DISTINCT doc_id, s, m FROM occ)) GROUP BY 1),
own AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM occ) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN own USING (doc_id)
"""

SQL["op6_mix_sources"] = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    coalesce('=' || source, '') AS src, coalesce(CAST(doc_id AS VARCHAR), '') AS name,
    CAST('0x' || substr(md5('0:' || coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 13) AS BIGINT) AS pos
  FROM documents),
s AS (SELECT src, any_value(source) AS source, sum(size) AS source_size FROM d GROUP BY 1),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
    WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS w, CAST(2 * source_size AS DOUBLE) AS cap FROM s),
l AS (SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) * 150 / 100.0::DOUBLE - coalesce(sum(cap) OVER o, 0) AS rest,
    sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS w_left, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS nth
  FROM w WINDOW o AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
stop AS (SELECT min(nth) AS nth, arg_min(rest, nth) AS rest, arg_min(w_left, nth) AS w_left
  FROM l WHERE rest * w / w_left < cap),
t AS (SELECT l.src, l.source_size, CASE WHEN stop.nth IS NULL OR l.nth < stop.nth THEN cap
    ELSE stop.rest * w / stop.w_left END AS target FROM l, stop),
q AS (SELECT d.*, t.source_size, t.target, sum(size) OVER (PARTITION BY src ORDER BY pos, name, size) AS cum
  FROM d JOIN t USING (src)),
c AS (SELECT src, name, size, pos, CAST(cum + k * source_size AS DOUBLE) / target AS finish
  FROM q, (VALUES (0), (1)) v(k) WHERE size > 0),
r AS (SELECT *, sum(size) OVER (ORDER BY finish, pos, src, name, size) AS total,
    (SELECT sum(size) FROM d) AS words FROM c),
n AS (SELECT src, name, pos, size, count(*) AS copies FROM r WHERE total * 100 <= words * 150 GROUP BY ALL),
same AS (SELECT src, name, pos, size, count(*) AS rows FROM d GROUP BY ALL)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
  CAST(size * coalesce(copies // rows, 0) AS BIGINT) AS taken
FROM q JOIN same USING (src, name, pos, size) LEFT JOIN n USING (src, name, pos, size)
"""

SQL["op8_near_dedup"] = rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, s, s + 1), ' ') AS x
  FROM d, LATERAL (SELECT unnest(range(1, greatest(len(w) - 1, 1) + 1)) AS s) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
c AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common FROM sh a JOIN sh b USING (x)
  WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT u, v FROM c JOIN n p ON p.doc_id = u JOIN n q ON q.doc_id = v WHERE 100 * common >= 80 * (p.n + q.n - common)),
e AS (SELECT u, v FROM l UNION SELECT v, u FROM l),
r AS (SELECT doc_id AS x, doc_id AS y FROM d WHERE doc_id IS NOT NULL UNION SELECT r.x, e.v FROM r JOIN e ON e.u = r.y),
m AS (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY 1)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""

SQL["op10_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
win AS (SELECT doc_id, s, md5(array_to_string(list_slice(w, s, s + 12), ' ')) AS p
  FROM d, LATERAL (SELECT unnest(range(1, len(w) - 11)) AS s)),
own AS (SELECT p, min(doc_id) AS first FROM win GROUP BY 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS i FROM win JOIN own USING (p) WHERE doc_id > first),
word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY 1),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

SQL["op12_lexical_search"] = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS doc, coalesce({_ITEM_WORDS}, []) AS w FROM documents),
q AS (SELECT item_id, row_number() OVER () AS item, coalesce({_ITEM_WORDS}, []) AS w FROM benchmark),
s AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
m AS (SELECT doc, doc_id, 100 - 90 + (90 * len(w) * n_docs) // n_terms AS m FROM d, s WHERE len(w) > 0),
tf AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(w) AS term FROM d) GROUP BY 1, 2),
wt AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, s GROUP BY term, n_docs),
qt AS (SELECT DISTINCT item, unnest(w) AS term FROM q),
sc AS (SELECT item, doc, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM qt JOIN wt USING (term) JOIN tf USING (term) JOIN m USING (doc) GROUP BY 1, 2),
r AS (SELECT item, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM sc JOIN m USING (doc) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r JOIN q USING (item) WHERE rank <= 10
"""

SQL["op13_collocations"] = rf"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(coalesce({_LOWER}, ''), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
t AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY 1),
g AS (SELECT lang, k, list_slice(w, s, s + k - 1) AS x, count(*) AS f
  FROM p, (VALUES (1), (2), (3)) v(k), LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS s) GROUP BY ALL),
c AS (SELECT lang, k, x, f AS a FROM g WHERE k > 1 AND f >= 10),
cut AS (SELECT c.*, h, u.f AS l, v.f AS r, (1000000::HUGEINT * a * a) // (u.f::HUGEINT * v.f) AS score
  FROM c, (VALUES (1), (2)) z(h)
  JOIN g u ON u.lang = c.lang AND u.x = list_slice(c.x, 1, h)
  JOIN g v ON v.lang = c.lang AND v.x = list_slice(c.x, h + 1, c.k) WHERE h < c.k),
worst AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, x ORDER BY score, h) = 1),
longer AS (SELECT lang, y, max(a) AS f FROM (SELECT lang, a, unnest([list_slice(x, 1, 2), list_slice(x, 2, 3)]) AS y
  FROM c WHERE k = 3) GROUP BY 1, 2),
kept AS (SELECT w.* FROM worst w LEFT JOIN longer o ON o.lang = w.lang AND o.y = w.x
  WHERE w.k = 3 OR o.f IS NULL OR 100 * o.f < 50 * w.a),
r AS (SELECT *, array_to_string(x, ' ') AS phrase,
  row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(x, ' ')) AS rank FROM kept)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM r JOIN t USING (lang) WHERE rank <= 2000
"""
