"""SQL of the queries of this package that SQL can express."""

ORACLES: dict[str, str] = {"op13_collocations": r"""
WITH lowered AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
pieces AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM lowered),
spoken AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces),
phrases AS (
  SELECT lang, m, words[i:i + m - 1] AS words
  FROM (SELECT lang, words, m, unnest(range(1, len(words) - m + 2)) AS i FROM spoken, (VALUES (1), (2), (3), (4)) AS sizes(m))),
counts AS (SELECT lang, m, words, count(*) AS f FROM phrases GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE m = 1 GROUP BY lang),
candidates AS (SELECT lang, m, words, f AS a FROM counts WHERE m > 1 AND f >= 30),
inner_phrases AS (
  SELECT DISTINCT c.lang, c.words[i:j] AS words, c.a AS longer
  FROM candidates c, range(1, 4) AS s(i), range(2, 5) AS e(j) WHERE j > i AND j <= c.m AND j - i + 1 < c.m),
kept AS (
  SELECT * FROM candidates c WHERE NOT EXISTS (
    SELECT 1 FROM inner_phrases p WHERE p.lang = c.lang AND p.words = c.words AND 100 * p.longer >= 80 * c.a)),
cuts AS (
  SELECT c.lang, c.words, c.a, k, l.f AS l, r.f AS r, (2000000 * c.a::HUGEINT // (l.f + r.f))::BIGINT AS score
  FROM kept c JOIN range(1, 4) AS t(k) ON k < c.m
  JOIN counts l ON l.lang = c.lang AND l.words = c.words[1:k] JOIN counts r ON r.lang = c.lang AND r.words = c.words[k + 1:c.m]),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
ranked AS (
  SELECT *, array_to_string(words, ' ') AS phrase,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(words, ' ')) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""}
