"""DuckDB SQL with the rows of the queries that SQL can express."""

OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_sum(list_transform(list_zip(q.v, d.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM p
)
SELECT * FROM r WHERE rank <= 5
"""

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_LINES = r"list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]'))"

OP4_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, {_WORDS} AS words, {_LINES} AS lines FROM documents
), win AS (
  SELECT r, i, list_aggregate(words[i:i + 7], 'string_agg', ' ') AS win FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM d)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM win) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, range(0, 8) t(k) GROUP BY r
), b AS (
  SELECT r, doc_id, source, lines, len(words)::BIGINT AS n_words, length(list_aggregate(words, 'string_agg', '')) AS wc,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines
  FROM d
), l AS (
  SELECT r, source, CASE WHEN k = '' THEN trim(line) ELSE k END AS k, n FROM (
    SELECT r, source, line, lower(trim(regexp_replace(line, '[^\p{{L}}]+', ' ', 'g'))) AS k, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
    FROM (SELECT r, source, unnest(lines) AS line FROM d)
  )
), f AS (
  SELECT k, source FROM (SELECT k, source, count(DISTINCT r) AS n FROM l GROUP BY ALL) JOIN (SELECT source AS s, count(*) AS docs FROM d GROUP BY ALL)
    ON source IS NOT DISTINCT FROM s WHERE n > greatest(0.01::DOUBLE * docs, least(20, 0.05::DOUBLE * docs), 2)
), gone AS (
  SELECT r, sum(n)::BIGINT AS n FROM l WHERE EXISTS (SELECT 1 FROM f WHERE f.k = l.k AND f.source IS NOT DISTINCT FROM l.source) GROUP BY r
), m AS (
  SELECT doc_id, n_words, coalesce(wc, 0)::BIGINT AS word_chars, n_symbols, n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    coalesce(gone.n, 0)::BIGINT AS n_removed_words
  FROM b LEFT JOIN covered USING (r) LEFT JOIN gone USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  n_removed_words, NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_words - n_removed_words >= 0.3 * n_words AS kept
FROM m
"""

OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM s
), o AS (
  SELECT *, row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / weight) AS place FROM w
), c AS (
  SELECT *, sum(2 * source_size) OVER (ORDER BY place) - 2 * source_size AS before, sum(weight) OVER (ORDER BY place DESC) AS after,
    1.5::DOUBLE * sum(source_size) OVER () AS total FROM o
), level AS (
  SELECT (total - before::DOUBLE) / after AS level FROM c WHERE weight * ((total - before::DOUBLE) / after) <= 2 * source_size ORDER BY place LIMIT 1
), t AS (
  SELECT source, source_size, least(weight * level, (2 * source_size)::DOUBLE) AS target,
    (('0x' || substr(md5('17|' || coalesce(source, '<null>')), 1, 13))::BIGINT)::DOUBLE / 4503599627370496 AS random FROM w, level
), r AS (
  SELECT d.*, t.source_size, t.target, t.random, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS each,
    row_number() OVER (PARTITION BY d.source ORDER BY size, md5(concat_ws(':', '17', doc_id::VARCHAR)), doc_id NULLS LAST) AS k
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, ((floor(k * each + random) - floor((k - 1) * each + random)) * size)::BIGINT AS taken FROM r
"""
