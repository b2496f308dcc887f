"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from . import quality

OP5 = r"""
WITH d AS (
  SELECT doc_id, source, text,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::bigint AS source_size,
         [3, 1, 2][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::int] AS weight
  FROM d GROUP BY source
), l AS (
  SELECT *, (2 * source_size)::double AS cap, (2 * source_size)::double / weight AS ratio FROM s
), v AS (
  SELECT *, (1.5::double * (sum(source_size) OVER ())::bigint
             - coalesce(sum(cap) OVER (ORDER BY ratio, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / ((sum(weight) OVER ()) - coalesce(sum(weight) OVER (ORDER BY ratio, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::bigint AS level
  FROM l
), f AS (SELECT level AS final FROM v WHERE ratio > level ORDER BY ratio, source ASC NULLS LAST LIMIT 1
), t AS (
  SELECT source, source_size,
         CASE WHEN ratio <= level OR (SELECT final FROM f) IS NULL THEN cap ELSE (SELECT final FROM f) * weight END AS target
  FROM v
), x AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5(concat_ws(':', '17', coalesce(d.doc_id::varchar, ''), coalesce(d.source, ''), coalesce(d.text, ''))), 1, 13))::bigint
           / 4503599627370496::double AS draw
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate)::bigint + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::bigint AS taken
FROM x
"""

OP10 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         string_split(coalesce(text, ''), chr(10)) AS l
  FROM documents
), g AS (
  SELECT r, i, row(w[i], w[i+1], w[i+2], w[i+3], w[i+4]) AS x
  FROM (SELECT r, w, unnest(generate_series(1, len(w) - 4)) AS i FROM d)
), p AS (
  SELECT r, least(5, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 5)) AS c
  FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS n FROM g) WHERE n > 1
), k AS (SELECT r, sum(c)::bigint AS n FROM p GROUP BY r
), u AS (
  SELECT r, line, lead(line) OVER (PARTITION BY r ORDER BY j) AS after, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS lw,
         length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS lc
  FROM (SELECT r, unnest(l) AS line, unnest(generate_series(1, len(l))) AS j FROM d)
), b AS (
  SELECT r, count(*)::bigint AS n, sum(lc)::bigint AS lost FROM u
  WHERE lw > 0 AND (
    (lw >= {quality.SENTENCE_WORDS} AND NOT regexp_matches(line, '{quality.ENDED.replace("'", "''")}') AND NOT coalesce(regexp_matches(after, '{quality.GOES_ON}'), false))
    OR 100 * len(regexp_extract_all(line, '[#*$%&|<>]')) > {quality.MOST_SYMBOLS} * length(line)
    OR (lw >= 3 AND 100 * len(regexp_extract_all(line, '{quality.SHOUTED}')) > {quality.MOST_SHOUTED} * lw)
    OR len(regexp_extract_all(line, '{quality.SEPARATED}')) >= {quality.LEAST_SEPARATORS}
    OR (length(line) <= {quality.SHORT_LINE} AND regexp_matches(line, '{quality.NAVIGATION}'))
    OR regexp_matches(line, '{quality.BOILERPLATE}'))
  GROUP BY r
), y AS (
  SELECT r, (count(*) - count(DISTINCT line))::bigint AS n FROM u WHERE lw > 0 GROUP BY r
), z AS (
  SELECT doc_id, len(w)::bigint AS n_words, length(list_aggregate(w, 'string_agg', ''))::bigint AS wc,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint AS n_symbols,
         coalesce(y.n, 0) AS n_dup_lines, coalesce(k.n, 0) AS n_repeat_words,
         coalesce(b.n, 0) AS n_bad_lines, coalesce(b.lost, 0) AS lost_chars
  FROM d LEFT JOIN k USING (r) LEFT JOIN b USING (r) LEFT JOIN y USING (r)
)
SELECT doc_id, n_words, coalesce(wc, 0) AS word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * lost_chars <= {quality.MOST_LOST} * coalesce(wc, 0) AS kept,
       n_bad_lines, lost_chars
FROM z
"""


OP6 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT r, doc_id, i, md5(array_to_string(w[i:i+49], ' ')) AS x
  FROM (SELECT r, doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM d)
), f AS (
  SELECT r, i FROM (SELECT r, doc_id, i, min(doc_id) OVER (PARTITION BY x) AS low FROM g) WHERE low < doc_id
), c AS (SELECT DISTINCT r, unnest(generate_series(i, i + 49)) AS i FROM f
), k AS (
  SELECT r, string_agg(x, ' ' ORDER BY i) AS t, count(*) AS n
  FROM (SELECT r, unnest(w) AS x, unnest(generate_series(1, len(w))) AS i FROM d) LEFT JOIN (SELECT r, i, true AS cut FROM c) USING (r, i)
  WHERE cut IS NULL GROUP BY r
)
SELECT doc_id, len(w)::bigint AS n_words, (len(w) - coalesce(n, 0))::bigint AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""

OP11 = r"""
WITH q AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) - 1 AS i, k, b
  FROM (SELECT conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k, strlen(coalesce(text, ''))::bigint AS b
        FROM conversations WHERE conv_id IS NOT NULL)
), c AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base,
         xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
               lambda acc, x: list_reduce(list_concat([xor(acc, x)], [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda r, z: xor(r >> 1, 3988292384::bigint * (r & 1)))),
             4294967295::bigint) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM q)
), r AS (
  SELECT c.conv_id, 0 AS part, i, k, b FROM c JOIN q ON q.conv_id = base AND i < h
  UNION ALL
  SELECT c.conv_id, 1, i, k, b FROM c JOIN q ON q.conv_id = c.conv_id AND i >= h
), p AS (
  SELECT conv_id, row_number() OVER w AS depth, sha256(string_agg(k, '') OVER w) AS prefix, b, count(*) OVER (PARTITION BY conv_id) AS length
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  UNION ALL
  SELECT c.conv_id, 0, '', 0, coalesce(n, 0) FROM c LEFT JOIN (SELECT conv_id, count(*) AS n FROM r GROUP BY conv_id) USING (conv_id)
), n AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, max(b) AS b, max(length) AS longest,
         sha256(coalesce(string_agg(conv_id::varchar, ',' ORDER BY conv_id) FILTER (length = depth), '')) AS ends_sha256
  FROM p GROUP BY depth, prefix
), u AS (
  SELECT p.depth, p.prefix, sum((n.n_convs - 1) * n.b)::bigint AS saved, count_if(n.longest = n.depth)::bigint AS leaves, count_if(n.depth = p.depth + 1)::bigint AS children
  FROM n JOIN p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY p.depth, p.prefix
), a AS (
  SELECT n.conv_id, n.depth, m.conv_id AS parent_conv_id
  FROM n JOIN p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1 JOIN n AS m ON m.depth = p.depth AND m.prefix = p.prefix
)
SELECT n.conv_id, n.depth::bigint AS depth, parent_conv_id, n_convs::bigint AS n_convs, children AS n_children, leaves AS n_leaves, saved AS saved_tokens, ends_sha256
FROM n JOIN u USING (depth, prefix) LEFT JOIN a ON a.conv_id = n.conv_id AND a.depth = n.depth
"""

OP13 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang,
         string_split(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]', chr(10), 'g'), chr(10)) AS pieces
  FROM documents
), e AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(pieces) AS piece FROM d)
), o AS (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM e WHERE len(w) > 0
), g AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM o, (VALUES (1), (2), (3), (4)) AS s(m) WHERE i + m - 1 <= len(w)
), f AS (SELECT lang, m, phrase, count(*)::bigint AS f FROM g GROUP BY lang, m, phrase
), n AS (SELECT lang, sum(f)::bigint AS n FROM f WHERE m = 1 GROUP BY lang
), c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= 30
), s AS (
  SELECT lang, m, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:m], ' ') AS tail
  FROM (SELECT *, unnest(generate_series(1, m - 1)) AS k FROM c)
), k AS (
  SELECT s.*, x.f AS l, y.f AS r, ((2000000::hugeint * a) // (x.f + y.f))::bigint AS score
  FROM s JOIN f AS x ON x.lang = s.lang AND x.phrase = s.head JOIN f AS y ON y.lang = s.lang AND y.phrase = s.tail
), b AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), i AS (
  SELECT lang, f, array_to_string(w[j:j + n - 1], ' ') AS phrase
  FROM (SELECT lang, a AS f, m, w, n, unnest(generate_series(1, m - n + 1)) AS j FROM (SELECT *, unnest(generate_series(2, m - 1)) AS n FROM c WHERE m > 2))
), z AS (
  SELECT DISTINCT b.lang, b.phrase FROM b JOIN i USING (lang, phrase) WHERE 100 * i.f >= 80 * b.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::bigint AS rank, phrase, a, l, r, n, score
FROM b ANTI JOIN z USING (lang, phrase) JOIN n USING (lang)
QUALIFY rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_mixing": OP5, "op6_repeated_passages": OP6, "op10_quality_rules": OP10, "op11_prefix_trie": OP11, "op13_collocations": OP13}
