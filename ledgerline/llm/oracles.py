"""DuckDB SQL for the queries of this package that SQL can express."""

MIX = r"""
WITH sized AS (
  SELECT doc_id, source, md5(text) AS digest, md5('0:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, source_size * 2.0::DOUBLE AS cap,
         list_value(3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE)[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM per),
full_at AS (SELECT *, cap / weight AS full_at FROM weighed),
swept AS (
  SELECT *, coalesce(sum(cap) OVER w, 0) AS cap_before, coalesce(sum(weight) OVER w, 0) AS weight_before,
         sum(source_size) OVER () * 1.5::DOUBLE AS total, sum(weight) OVER () AS weights
  FROM full_at
  WINDOW w AS (ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (SELECT *, (total - cap_before) / (weights - weight_before) AS level FROM swept),
best AS (SELECT level FROM levels WHERE full_at >= level ORDER BY full_at, level DESC LIMIT 1),
targets AS (
  SELECT source, source_size, least(cap, coalesce(weight * (SELECT level FROM best), cap)) AS target FROM weighed),
placed AS (
  SELECT doc_id, source, size, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id NULLS LAST, digest NULLS LAST
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized),
cuts AS (
  SELECT doc_id, size, before, source_size, target, round(target)::BIGINT AS budget,
         CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END AS epochs
  FROM placed JOIN targets ON placed.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target,
       epochs * size + least(greatest(budget - epochs * source_size - before, 0), size) AS taken
FROM cuts
"""

TOP_K = """
WITH vecs AS (
  SELECT vec_id, [floor(64 * CAST(x AS DOUBLE))::BIGINT for x in embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum([coalesce(p[1], 0) * coalesce(p[2], 0) for p in list_zip(q.v, c.v)])::BIGINT AS score
  FROM vecs q JOIN vecs c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

SUFFIX_DEDUP = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, h, unnest(range(greatest(length(h) // 2 - 49, 0))) AS k FROM d),
windows AS (SELECT doc_id, k, substr(h, 2 * k + 1, 100) AS win FROM w),
firsts AS (SELECT win, min(doc_id) AS first_doc FROM windows GROUP BY win),
gone AS (SELECT doc_id, k FROM windows JOIN firsts USING (win) WHERE first_doc < doc_id),
heads AS (SELECT doc_id, k, CASE WHEN k > lag(k, 1, -100) OVER (PARTITION BY doc_id ORDER BY k) + 50 THEN 1 ELSE 0 END AS head FROM gone),
numbered AS (SELECT doc_id, k, sum(head) OVER (PARTITION BY doc_id ORDER BY k) AS run FROM heads),
runs AS (SELECT doc_id, run, min(k) AS s, max(k) + 50 AS e FROM numbered GROUP BY doc_id, run),
placed AS (SELECT *, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY s) AS last_e FROM runs),
cut AS (
  SELECT doc_id, sum(e - s) AS n_removed, count(*) AS n_spans,
         string_agg(substr(h, last_e * 2 + 1, (s - last_e) * 2), '' ORDER BY s) || substr(any_value(h), max(e) * 2 + 1) AS kept
  FROM placed JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""

JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words
  FROM documents),
places AS (SELECT doc_id, words, unnest(range(greatest(len(words) - 4, least(len(words), 1)))) AS k FROM w),
grams AS (SELECT DISTINCT doc_id, array_to_string(words[k + 1:k + 5], ' ') AS gram FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c
           FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT u, v FROM common JOIN sizes a ON u = a.doc_id JOIN sizes b ON v = b.doc_id WHERE 100 * c >= 80 * (a.n + b.n - c)),
edges AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM w UNION SELECT reach.doc_id, edges.v FROM reach JOIN edges ON reach.other = edges.u)
SELECT w.doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(other) AS component_id
FROM w LEFT JOIN sizes USING (doc_id) JOIN reach USING (doc_id) GROUP BY w.doc_id
"""

DIVERGENCE = r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
groups AS (SELECT DISTINCT lang, source FROM d),
use AS (SELECT doc, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM use GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
langs AS (SELECT lang, coalesce(v, 0)::HUGEINT AS v, coalesce(total, 0)::HUGEINT AS total
          FROM (SELECT DISTINCT lang FROM groups) LEFT JOIN (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang) USING (lang)),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM use SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
totals AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM groups LEFT JOIN counts USING (lang, source) GROUP BY lang, source),
prices AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
         1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (g.total + l.v) AS p, 1 + (1000000000 * (kept.n::HUGEINT + 1)) // (l.total + l.v) AS lang_p
  FROM totals g JOIN langs l USING (lang) JOIN kept USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM prices a JOIN prices b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source),
above AS (SELECT lang, source, term AS item, (p - lang_p) * (p - lang_p) // lang_p AS value FROM prices WHERE n > 0 AND p > lang_p),
parts AS (SELECT *, 'pair' AS part FROM pairs UNION ALL SELECT *, 'term' AS part FROM above),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank FROM parts)
SELECT lang, source, part, item, value::BIGINT AS value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""

# DuckDB has no CRC-32: its table of 256 remainders, and a fold over the bytes of each distinct (document, run)
SPELLING = r"""
WITH RECURSIVE bits AS (
  SELECT i, 0 AS k, i AS c FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
remainders AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
d AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+') AS runs FROM documents),
r AS (SELECT doc, translate(unnest(runs), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM d),
each AS (SELECT doc, run, count(*) AS n FROM r GROUP BY doc, run),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode(doc || ':' || run))),
                                   lambda k: ('0x' || substr(hex(encode(doc || ':' || run)), 2 * k + 1, 2))::BIGINT)),
                             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM each, remainders),
typed AS (SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2) ELSE run END AS word FROM hashed),
v AS (SELECT word, sum(n)::BIGINT AS n FROM typed WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
places AS (SELECT word, n, unnest(range(length(word)))::INTEGER AS k FROM v),
gaps AS (SELECT word, n, k, substr(word, 1, k) || substr(word, k + 2) AS rest FROM places),
near AS (
  SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n FROM gaps a JOIN gaps b ON a.k = b.k AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT gaps.word, gaps.n, v.word, v.n FROM gaps JOIN v ON v.word = rest
  UNION SELECT v.word, v.n, gaps.word, gaps.n FROM gaps JOIN v ON v.word = rest),
best AS (
  SELECT word, n, near AS form, near_n AS form_n, count(*) OVER (PARTITION BY word) AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY near_n DESC, encode(near)) AS place FROM near),
forms AS (SELECT word, n_near, CASE WHEN form_n >= 10 * n THEN form END AS form, CASE WHEN form_n >= 10 * n THEN form_n END AS form_n FROM best WHERE place = 1),
chain AS (
  SELECT word, word AS place FROM v
  UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.place WHERE forms.form IS NOT NULL),
roots AS (SELECT word, place AS root FROM chain WHERE place NOT IN (SELECT word FROM forms WHERE form IS NOT NULL))
SELECT word, form, root, n, coalesce(n_near, 0)::BIGINT AS n_near, form_n FROM v JOIN roots USING (word) LEFT JOIN forms USING (word)
"""

UNIT_DEDUP = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS (SELECT doc_id, regexp_extract_all(text, '(?:[^\x20\x09-\x0D]*[^\x20\x09-\x0D.!?][\x20\x09\x0B-\x0D]+)*[^\x20\x09-\x0D]+[\x20\x09-\x0D]*') AS us FROM d),
each AS (SELECT doc_id, unnest(range(len(us))) AS k, us FROM found),
named AS (
  SELECT doc_id, k, us[k + 1] AS unit,
         translate(array_to_string(regexp_extract_all(us[k + 1], '[^\x20\x09-\x0D]+'), ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS name,
         len(regexp_extract_all(us[k + 1], '[^\x20\x09-\x0D]+')) AS words
  FROM each),
placed AS (
  SELECT *, coalesce(sum(CASE WHEN contains(unit, chr(10)) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS line,
         row_number() OVER (PARTITION BY name ORDER BY doc_id, k) > 1 AS later
  FROM named),
lines AS (SELECT doc_id, line, string_agg(name, ' ' ORDER BY k) AS name FROM placed GROUP BY doc_id, line),
later_lines AS (SELECT doc_id, line, row_number() OVER (PARTITION BY name ORDER BY doc_id, line) > 1 AS later_line FROM lines),
runs AS (SELECT *, k - row_number() OVER (PARTITION BY doc_id ORDER BY k) AS run FROM placed WHERE later),
long AS (SELECT doc_id, k, sum(words) OVER (PARTITION BY doc_id, run) >= 10 AS in_run FROM runs),
marked AS (
  SELECT placed.doc_id, placed.k, unit, coalesce(in_run, FALSE) OR later_line AS goes
  FROM placed JOIN later_lines USING (doc_id, line) LEFT JOIN long ON long.doc_id = placed.doc_id AND long.k = placed.k),
spanned AS (SELECT *, goes AND NOT coalesce(lag(goes) OVER (PARTITION BY doc_id ORDER BY k), FALSE) AS begins FROM marked),
cut AS (
  SELECT doc_id, count_if(goes) AS n_units, count_if(begins) AS n_spans, coalesce(sum(strlen(unit)) FILTER (WHERE goes), 0) AS n_removed,
         coalesce(string_agg(unit, '' ORDER BY k) FILTER (WHERE NOT goes), '') AS kept
  FROM spanned GROUP BY doc_id)
SELECT doc_id, strlen(text)::BIGINT AS n_bytes, coalesce(n_units, 0)::BIGINT AS n_units, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(regexp_extract(text, '^[\x20\x09-\x0D]*') || coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""
