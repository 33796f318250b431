"""DuckDB SQL of the operators that SQL can state."""

_WORD = "'[^ \t-\r]+'"

QUALITY = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce('h' || source, '') AS host, coalesce(text, '') AS body FROM documents),
w AS (SELECT r, regexp_extract_all(body, {_WORD}) AS words FROM d),
g AS (SELECT r, p, len(words) AS n,
             words[p] || ' ' || words[p + 1] || ' ' || words[p + 2] || ' ' || words[p + 3] || ' ' || words[p + 4] AS win
      FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS p FROM w WHERE len(words) >= 5)),
gg AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, win) AS c FROM g) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT p + k) AS n_repeat_words FROM gg, (VALUES (0), (1), (2), (3), (4)) AS t(k) GROUP BY r),
ln AS (SELECT r, host, md5(body) AS key, unnest(string_split(body, chr(10))) AS line FROM d),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM ln WHERE regexp_matches(line, {_WORD}) GROUP BY r),
nl AS (SELECT r, host, key, norm, len(regexp_extract_all(norm, '[^ ]+')) AS words
       FROM (SELECT r, host, key, trim(regexp_replace(regexp_replace(lower(line), '[0-9]', '0', 'g'), '[ \t-\r]+', ' ', 'g')) AS norm FROM ln)
       WHERE norm <> ''),
hosts AS (SELECT host, count(DISTINCT md5(body)) AS host_docs FROM d GROUP BY host),
common AS (SELECT host, norm FROM (SELECT host, norm, count(DISTINCT key) AS held FROM nl WHERE words >= 3 GROUP BY host, norm) JOIN hosts USING (host)
           WHERE held >= 3 AND held > host_docs * 0.05),
cut AS (SELECT r, sum(words) AS c FROM nl JOIN common USING (host, norm) WHERE words >= 3 GROUP BY r),
m AS (SELECT d.r, doc_id, CAST(len(words) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(body, '[ \t-\r]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
             CAST(len(words) - coalesce(c, 0) AS BIGINT) AS n_words_left
      FROM d JOIN w USING (r) LEFT JOIN dup USING (r) LEFT JOIN rep USING (r) LEFT JOIN cut USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT (n_words_left < 10 OR n_words_left < n_words * 0.3) AS kept,
       n_words_left
FROM m
"""

NGRAM_JOIN = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WORD}) AS w FROM documents),
s AS (SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
             ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) END AS g FROM d),
n AS (SELECT r, doc_id, CAST(len(g) AS BIGINT) AS n FROM s),
e AS (SELECT r, unnest(g) AS x FROM s),
c AS (SELECT a.r AS ra, b.r AS rb, count(*) AS both_have FROM e a JOIN e b ON a.x = b.x AND a.r <> b.r GROUP BY a.r, b.r),
l AS (SELECT ra, rb FROM c JOIN n p ON p.r = ra JOIN n q ON q.r = rb WHERE 100 * both_have >= 90 * (p.n + q.n - both_have)),
t(r, o) AS (SELECT r, r FROM n UNION SELECT t.r, l.rb FROM t JOIN l ON l.ra = t.o)
SELECT n.doc_id, n.n AS n_shingles, min(o.doc_id) AS component_id
FROM n JOIN t ON t.r = n.r JOIN n o ON o.r = t.o GROUP BY n.r, n.doc_id, n.n
"""

NGRAM_LINKS = NGRAM_JOIN[: NGRAM_JOIN.index(",\nt(r, o)")] + """
SELECT n.doc_id, n.n AS n_shingles, count(l.rb) AS n_links FROM n LEFT JOIN l ON l.ra = n.r GROUP BY n.r, n.doc_id, n.n
"""

LINE_DEDUP = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text, md5(coalesce(text, '')) AS key, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
ln AS (SELECT key, min(doc_id) AS doc_id, no, any_value(line) AS line
       FROM (SELECT key, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS no FROM d) GROUP BY key, no),
sh AS (SELECT *, string_split(shape, ' ') AS tok, len(string_split(shape, ' ')) AS n
       FROM (SELECT *, length(words) AS chars, regexp_replace(words, '[^ ]*[0-9][^ ]*', '<*>', 'g') AS shape
             FROM (SELECT *, trim(regexp_replace(line, '[ \t-\r]+', ' ', 'g')) AS words FROM ln))),
h AS (SELECT *, array_to_string(tok[1:3], ' ') AS lead FROM sh WHERE n >= 5),
many AS (SELECT n, lead, count(*) AS lines FROM h GROUP BY n, lead HAVING count(DISTINCT key) >= 2),
p AS (SELECT n, lead, unnest(tok) AS token, generate_subscripts(tok, 1) AS place FROM h JOIN many USING (n, lead)),
top AS (SELECT *, row_number() OVER (PARTITION BY n, lead, place ORDER BY times DESC, token DESC) AS k
        FROM (SELECT n, lead, place, token, count(*) AS times FROM p GROUP BY n, lead, place, token)),
con AS (SELECT n, lead, place, token FROM top JOIN many USING (n, lead) WHERE k = 1 AND times * 2 >= lines),
fit AS (SELECT key, no, count(*) AS fits FROM (SELECT key, no, n, lead, unnest(tok) AS token, generate_subscripts(tok, 1) AS place FROM h JOIN many USING (n, lead))
        JOIN con USING (n, lead, place, token) GROUP BY key, no),
tp AS (SELECT h.key, h.no, h.doc_id, h.n, h.chars, CASE WHEN coalesce(fits, 0) >= h.n * 0.7 THEN 'leaf ' || h.n || ' ' || lead ELSE 'line ' || shape END AS template
       FROM h JOIN many USING (n, lead) LEFT JOIN fit ON fit.key = h.key AND fit.no = h.no),
found AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY template ORDER BY doc_id, key, no) AS k,
                                first_value(key) OVER (PARTITION BY template ORDER BY doc_id, key, no) AS first_key FROM tp)
          WHERE k > 1 AND template IN (SELECT template FROM tp GROUP BY template HAVING count(DISTINCT key) >= CASE WHEN max(n) > 50 THEN 2 ELSE 3 END)),
one AS (SELECT key, any_value(coalesce(text, '')) AS body FROM d GROUP BY key),
prs AS (SELECT f.key, first_key FROM found f JOIN one USING (key) WHERE f.key <> first_key GROUP BY f.key, first_key HAVING sum(chars) >= any_value(length(body)) * 0.25),
sets AS (SELECT key, list_distinct([w[i:i + 4] FOR i IN range(1, len(w) - 3)]) AS g
         FROM (SELECT key, regexp_extract_all(body, '[^ \t-\r]+') AS w FROM one WHERE key IN (SELECT key FROM prs UNION SELECT first_key FROM prs))),
near AS (SELECT key, first_key FROM (SELECT p.key, first_key, len(a.g) + len(b.g) AS sizes, len(list_intersect(a.g, b.g)) AS both_have
                                     FROM prs p JOIN sets a ON a.key = p.key JOIN sets b ON b.key = p.first_key)
         WHERE 100 * both_have >= 80 * (sizes - both_have)),
go AS (SELECT key, no FROM found ANTI JOIN near USING (key, first_key)),
o AS (SELECT d.r, count(go.no) AS n_dropped, string_agg(line, chr(10) ORDER BY q.no) FILTER (go.no IS NULL) AS clean, count(*) AS n_lines
      FROM (SELECT r, key, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS no FROM d) q JOIN d USING (r) LEFT JOIN go ON go.key = q.key AND go.no = q.no GROUP BY d.r)
SELECT d.doc_id, CASE WHEN n_dropped = 0 THEN d.text ELSE coalesce(clean, '') END AS text, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_dropped AS BIGINT) AS n_dropped
FROM d JOIN o USING (r)
"""
