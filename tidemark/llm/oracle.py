"""DuckDB SQL for the operators that SQL can express.

The others draw on hashes, learned models, heaps or random draws; their tests
compare them with brute force, a library, or held-out labels.
"""

_OP1 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT rid, i, array_to_string(words[i:i + 4], ' ') AS gram
      FROM (SELECT rid, words, unnest(generate_series(1, len(words) - 4)) AS i FROM w WHERE len(words) >= 6)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS c FROM g) WHERE c > 1),
p AS (SELECT rid, count(DISTINCT i + k) AS covered FROM r, (SELECT unnest(generate_series(0, 4)) AS k) GROUP BY rid),
s AS (SELECT w.rid, doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(covered, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN p USING (rid)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM s),
h AS (SELECT source, count(*) AS n, sum(CAST(base_failed AS INT)) AS bad FROM f GROUP BY source),
m AS (SELECT avg(bad / n) AS mean, var_pop(bad / n) AS var, avg(n) AS size FROM h),
k AS (SELECT mean, CASE WHEN var > 1e-12 AND mean > 0 AND mean < 1
                        THEN greatest(mean * (1 - mean) / var - 1, 1) ELSE size END AS k FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (h.bad + mean * k) / (h.n + k) <= 0.5 AS kept
FROM f JOIN h ON f.source IS NOT DISTINCT FROM h.source, k
"""

_OP13 = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang,
                  unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                      'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
           FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
s AS (SELECT lang, ws, unnest(generate_series(1, len(ws))) AS i FROM w),
f AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS a
      FROM s, (SELECT unnest(generate_series(1, 5)) AS k) WHERE i + k - 1 <= len(ws) GROUP BY ALL),
t AS (SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2 AND a >= 100),
i AS (SELECT DISTINCT lang, array_to_string(ws[x:y], ' ') AS phrase, a
      FROM c, (SELECT unnest(generate_series(1, 5)) AS x), (SELECT unnest(generate_series(1, 5)) AS y)
      WHERE x < y AND y <= k AND y - x + 1 < k),
z AS (SELECT c.* FROM c WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.lang = c.lang AND i.phrase = c.phrase
                                                             AND 100 * i.a >= 100 * c.a)),
u AS (SELECT z.lang, z.phrase, z.a, cut, array_to_string(z.ws[1:cut], ' ') AS lp,
             array_to_string(z.ws[cut + 1:], ' ') AS rp
      FROM z, (SELECT unnest(generate_series(1, 4)) AS cut) WHERE cut < k),
v AS (SELECT u.lang, u.phrase, u.a, cut, l.a AS l, r.a AS r, n,
             (1000::HUGEINT * u.a * n) // (l.a::HUGEINT * r.a) AS score
      FROM u JOIN f l ON l.lang = u.lang AND l.phrase = lp JOIN f r ON r.lang = u.lang AND r.phrase = rp
             JOIN t ON t.lang = u.lang),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS o FROM v),
k AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b WHERE o = 1)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM k WHERE rank <= 2000
"""

_OP11 = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
d AS (SELECT *, min(doc_id) OVER (PARTITION BY text) AS low FROM t),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic
      FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
x AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             CASE WHEN len(ws) < 100 THEN 'A' ELSE '' END
             || CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' ELSE '' END
             || CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text)
                     THEN 'C' ELSE '' END
             || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
             || CASE WHEN doc_id > low THEN 'E' ELSE '' END AS fails
      FROM d LEFT JOIN l USING (doc_id)),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM x GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM f a, f b, f c, f d, f e
      WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS before
      FROM o, (SELECT unnest(generate_series(1, 5)) AS step)),
j AS (SELECT part, filter_order, step, own, n, good, toxic, fails, contains(fails, own) AS hit,
             len(list_intersect(string_split(fails, ''), string_split(before, ''))) > 0 AND before <> '' AND fails <> '' AS gone
      FROM c, s),
r AS (SELECT part, filter_order, step, own, sum(CASE WHEN NOT hit AND NOT gone THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN hit AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
      FROM j GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM r
"""

ORACLE: dict[str, str] = {"op1_quality_rules": _OP1, "op11_filter_audit": _OP11, "op13_phrases": _OP13}
