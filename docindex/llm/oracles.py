"""The queries' results in DuckDB SQL."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# Words between ASCII white space; none for a NULL or empty text.
_WORDS = r"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"

ORACLES["op7_near_dups"] = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS words
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' ')) END) AS set
  FROM w
), e AS (SELECT doc_id, len(set) AS n, unnest(set) AS shingle FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS other FROM s
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
), c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(len(set) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM s JOIN c USING (doc_id)
"""

ORACLES["op6_substrings"] = rf"""
WITH d AS (SELECT doc_id, {_WORDS.format(text="text")} AS words FROM documents),
w AS (
  SELECT doc_id, start, array_to_string(words[start:start + 19], ' ') AS passage
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS start FROM d)
), later AS (
  SELECT doc_id, start FROM (
    SELECT doc_id, start, row_number() OVER (PARTITION BY passage ORDER BY doc_id, start) AS n FROM w)
  WHERE n > 1
), gone AS (SELECT DISTINCT doc_id, unnest(range(start, start + 20)) AS pos FROM later),
words AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS kept, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

ORACLES["op1_quality_rules"] = rf"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text, {_WORDS.format(text="text")} AS words
  FROM documents
), w AS (
  SELECT doc_id, pos, array_to_string(words[pos:pos + 7], ' ') AS passage
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS pos FROM d)
), many AS (
  SELECT doc_id, pos FROM (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, passage) AS n FROM w) WHERE n > 1
), r AS (
  SELECT doc_id, count(DISTINCT word) AS n FROM (SELECT doc_id, unnest(range(pos, pos + 8)) AS word FROM many) GROUP BY doc_id
), l AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d
), m AS (
  SELECT doc_id, host, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM d JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)
), f AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR n_symbols > 0.5 * n_words OR n_dup_lines > 0.02 * n_words
    OR (n_words > 0 AND (word_chars / n_words < 2 OR word_chars / n_words > 25)) AS any_failed
  FROM m
), h AS (
  SELECT host, count(*) AS docs, count(*) FILTER (any_failed) AS failed FROM f GROUP BY host
), p AS (
  SELECT coalesce(avg(failed / docs), 0.5) AS mean, var_pop(failed / docs) AS spread FROM h WHERE docs >= 5
), s AS (
  SELECT mean, CASE WHEN spread > 0 THEN least(greatest(mean * (1 - mean) / spread - 1, 1), 1000) ELSE 1000 END AS strength
  FROM p
), v AS (
  SELECT host, (failed + mean * strength) / (docs + strength) >= 0.5 AS refused FROM h, s
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (refused AND any_failed) AS kept
FROM f JOIN v USING (host)
"""

# Words of ASCII letters (A-Z as a-z), digits and characters beyond ASCII.
_PLAIN = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES["op12_decontamination"] = rf"""
WITH d AS (SELECT doc_id, {_PLAIN} AS words FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_PLAIN} AS words FROM benchmark),
w AS (
  SELECT DISTINCT item, size, array_to_string(words[pos:pos + size - 1], ' ') AS passage
  FROM (SELECT item, words, size, unnest(range(1, len(words) - size + 2)) AS pos
        FROM (SELECT item, words, least(len(words), 10) AS size FROM b WHERE len(words) > 0))
), p AS (
  SELECT doc_id, size, pos, array_to_string(words[pos:pos + size - 1], ' ') AS passage
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS pos
        FROM d, (SELECT DISTINCT size FROM w))
), found AS (SELECT doc_id, pos, size, item FROM p JOIN w USING (size, passage)),
hit AS (
  SELECT doc_id, count(DISTINCT word) AS n
  FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS word FROM (SELECT DISTINCT doc_id, pos, size FROM found))
  GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLES["op13_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^.,;:!?
-
]+')), '[^ 	]+') AS words
  FROM documents
), runs AS (
  SELECT lang, size, array_to_string(words[pos:pos + size - 1], ' ') AS phrase
  FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS pos FROM pieces, (SELECT unnest([1, 2, 3]) AS size))
), f AS (SELECT lang, size, phrase, count(*) AS f FROM runs GROUP BY lang, size, phrase),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE size > 1 AND f >= 10),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(words[1:k], ' ') AS first, array_to_string(words[k + 1:], ' ') AS rest
  FROM (SELECT lang, phrase, a, words, unnest(range(1, size)) AS k FROM c)
), scored AS (
  SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r,
    CAST((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.first JOIN f y ON y.lang = c.lang AND y.phrase = c.rest
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), parts AS (
  SELECT lang, a AS longer, array_to_string(words[pos:pos + 1], ' ') AS phrase
  FROM (SELECT lang, a, words, unnest([1, 2]) AS pos FROM c WHERE size = 3)
), kept AS (
  SELECT b.* FROM best b LEFT JOIN (SELECT lang, phrase, max(longer) AS longer FROM parts GROUP BY lang, phrase) p
    ON p.lang = b.lang AND p.phrase = b.phrase
  WHERE longer IS NULL OR 100 * longer < 50 * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN n USING (lang)
QUALIFY rank <= 2000
"""
