"""Named DuckDB subqueries: the derived catalogues, their cleaning, linkage and master table."""

from __future__ import annotations

import re

from fusework.sources.fixtures import catalog_sql
from oracles import expressions as E

_GENRES = "{list}"


def _genres(x: str) -> str:
    names = f"list_filter(list_transform({E.parsed_list(x)}, lambda gn: {E.genre('gn')}), lambda ge: ge <> '')"
    return names


CLEAN_A = f"""
SELECT row_id AS a_row_id, cast(id AS varchar) AS tmdb_id, trim(title) AS title_display_tmdb,
  title_norm, title_norm IS NULL AS title_missing, release_date,
  cast(year(release_date) AS integer) AS release_year, {E.decade('year(release_date)')} AS release_decade,
  release_date IS NULL AS year_missing,
  (year(release_date) < 1900 OR year(release_date) > 2026) AS year_out_of_range,
  runtime_raw, CASE WHEN rt > 0 AND rt <= 600 THEN rt END AS runtime_min,
  coalesce(rt = 0, false) AS runtime_was_zero, coalesce(rt <= 0 OR rt > 600, false) AS runtime_out_of_range,
  (CASE WHEN rt > 0 AND rt <= 600 THEN rt END) IS NULL AS runtime_missing,
  budget_usd, budget_status = 'zero_as_missing' AS budget_was_zero, budget_status AS budget_parse_status,
  budget_usd IS NULL AS budget_missing, budget_usd IS NOT NULL AS budget_observed,
  revenue_usd, revenue_status = 'zero_as_missing' AS revenue_was_zero, revenue_status AS revenue_parse_status,
  revenue_usd IS NULL AS revenue_missing, revenue_usd IS NOT NULL AS revenue_observed,
  va AS vote_average_tmdb_raw, vc AS vote_count_tmdb,
  coalesce(vc = 0, false) AS vote_count_zero, coalesce(va = 0, false) AS vote_average_zero,
  CASE WHEN coalesce(vc, 0) <> 0 AND va BETWEEN 0 AND 10 THEN va END AS vote_average_tmdb,
  (CASE WHEN coalesce(vc, 0) <> 0 AND va BETWEEN 0 AND 10 THEN va END) IS NULL AS rating_missing,
  pop AS popularity_tmdb, coalesce(pop = 0, false) AS popularity_zero,
  {E.or_unknown('gl')} AS genres_list_tmdb, len(gl) = 0 OR gl = ['Unknown'] AS genres_missing,
  '' AS production_companies, '' AS origin_country_clean,
  lower(trim(original_language)) AS original_language_clean, NULL::varchar AS adult
FROM (
  SELECT *, {E.title_key('title')} AS title_norm, {E.date('release_date_text')} AS release_date,
    {E.number('runtime')} AS rt, runtime AS runtime_raw,
    {E.money_value('budget')} AS budget_usd, {E.money_status('budget')} AS budget_status,
    {E.money_value('revenue')} AS revenue_usd, {E.money_status('revenue')} AS revenue_status,
    {E.number('vote_average')} AS va, {E.number('vote_count')} AS vc, {E.number('popularity')} AS pop,
    {E.ordered_distinct('raw_genres')} AS gl
  FROM (
    SELECT * EXCLUDE (release_date), release_date AS release_date_text, {_genres('genre_names')} AS raw_genres,
      row_number() OVER (PARTITION BY id ORDER BY row_id) AS rn
    FROM cat_a
  ) WHERE rn = 1
)
"""

CLEAN_B = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY title_norm, release_year ORDER BY
    (rating_imdb IS NOT NULL)::int + (runtime_min IS NOT NULL)::int + (overview <> '')::int DESC, b_row_id) AS rn
  FROM (
    SELECT row_id AS b_row_id, trim(path) AS imdb_path, trim(movie_title) AS title_display_imdb,
      title_norm, title_norm IS NULL AS title_missing, y AS year_raw, y < 0 AS year_was_negative,
      cast(abs(y) AS integer) AS release_year, y IS NULL AS year_missing,
      (abs(y) < 1900 OR abs(y) > 2026) AS year_out_of_range,
      make_date(cast(abs(y) AS integer), 1, 1) AS release_date, {E.decade('abs(y)')} AS release_decade,
      runtime_min, runtime_parse_status, runtime_min IS NULL AS runtime_missing,
      CASE WHEN r BETWEEN 0 AND 10 THEN r END AS rating_imdb,
      (CASE WHEN r BETWEEN 0 AND 10 THEN r END) IS NULL AS rating_missing,
      user_rating_count_imdb, {E.or_unknown('gl')} AS genres_list_imdb,
      len(gl) = 0 OR gl = ['Unknown'] AS genres_missing,
      trim(coalesce(overview, '')) AS overview, trim(coalesce(director, '')) AS director,
      trim(coalesce(writer, '')) AS writer, trim(coalesce(plot_kyeword, '')) AS keywords,
      trim(coalesce(top_5_casts, '')) AS "cast"
    FROM (
      SELECT *, {E.title_key('movie_title')} AS title_norm, {E.number('year')} AS y,
        {E.runtime_minutes('run_time')} AS runtime_min, {E.runtime_status('run_time')} AS runtime_parse_status,
        {E.number('rating')} AS r, {E.count_suffix('user_rating')} AS user_rating_count_imdb,
        {E.ordered_distinct('raw_genres')} AS gl
      FROM (SELECT *, {_genres('generes')} AS raw_genres FROM cat_b)
    )
  )
) WHERE rn = 1
"""


def _link(side: str, clean: str, ext: str, title: str, genres: str) -> str:
    return f"""
SELECT {side}_row_id AS row_id, {ext} AS ext_id, {title} AS title_display, title_norm, release_year, runtime_min,
  {E.genre_set(genres)} AS genre_set, title_norm[1] AS first_letter, string_split(title_norm, ' ')[1] AS main_token
FROM {clean} WHERE title_norm IS NOT NULL AND release_year IS NOT NULL"""


def _scored(pairs: str, title_sim: str, method: str, fixed: bool = False) -> str:
    """Audit columns over a subquery with aliases a and b (whole link rows)."""
    linkage = "100.0::double" if fixed else E.score("title_similarity", "year_similarity", "runtime_similarity", "genre_similarity")
    return f"""
SELECT *, '{method}' AS match_method, {E.status('linkage_score')} AS match_status FROM (
  SELECT *, {linkage} AS linkage_score FROM (
    SELECT a.row_id AS a_row_id, b.row_id AS b_row_id, a.ext_id AS a_id, b.ext_id AS b_id,
      a.title_display AS a_title, b.title_display AS b_title, a.release_year AS a_year, b.release_year AS b_year,
      a.runtime_min AS a_runtime, b.runtime_min AS b_runtime, {title_sim} AS title_similarity,
      {E.year_sim('a.release_year', 'b.release_year')} AS year_similarity,
      {E.runtime_sim('a.runtime_min', 'b.runtime_min')} AS runtime_similarity,
      {E.genre_sim('a.genre_set', 'b.genre_set')} AS genre_similarity
    FROM {pairs}
  )
)"""


def _resolved(inner: str) -> str:
    return f"""
SELECT * EXCLUDE (ra, rb) FROM (
  SELECT *, row_number() OVER (PARTITION BY b_row_id ORDER BY linkage_score DESC, a_row_id) AS rb FROM (
    SELECT *, row_number() OVER (PARTITION BY a_row_id ORDER BY linkage_score DESC, b_row_id) AS ra
    FROM ({inner})
  ) WHERE ra = 1
) WHERE rb = 1"""


EXACT = _resolved(_scored(
    "link_a a JOIN link_b b ON a.title_norm = b.title_norm AND a.release_year = b.release_year",
    "100.0::double", "exact_title_year", fixed=True,
))

REST = "SELECT * FROM {table} WHERE row_id NOT IN (SELECT {side}_row_id FROM {matched})"

PM1 = _resolved(_scored(
    "rest1_a a JOIN rest1_b b ON a.title_norm = b.title_norm AND abs(a.release_year - b.release_year) <= 1",
    "100.0::double", "exact_title_year_pm1",
))

BLOCK_PAIRS = """
SELECT a.row_id AS a_row_id, b.row_id AS b_row_id, a.title_norm AS a_key, b.title_norm AS b_key
FROM rest2_a a JOIN rest2_b b ON a.first_letter = b.first_letter AND abs(a.release_year - b.release_year) <= 1"""


def token_set(pairs: str, keep: str) -> str:
    """Adds ``token_set`` to a relation with the texts ``a_key`` and ``b_key``."""
    return f"""
SELECT {keep}, CASE WHEN s > 0 AND (x = 0 OR y = 0) THEN 100.0::double
  WHEN s > 0 THEN greatest(whole, 100.0::double * (1.0::double - (1 + x)::double / (s + s + 1 + x)),
    100.0::double * (1.0::double - (1 + y)::double / (s + s + 1 + y)))
  ELSE whole END AS token_set
FROM (
  SELECT *, 100.0::double * (1.0::double - (x + y - 2 * {E.lcs('only_a', 'only_b')})::double
    / (2 * (s + (s > 0)::int) + x + y)) AS whole
  FROM (
    SELECT *, length(shared) AS s, length(only_a) AS x, length(only_b) AS y FROM (
      SELECT *, array_to_string(list_filter(ta, lambda k1: list_contains(tb, k1)), ' ') AS shared,
        array_to_string(list_filter(ta, lambda k2: NOT list_contains(tb, k2)), ' ') AS only_a,
        array_to_string(list_filter(tb, lambda k3: NOT list_contains(ta, k3)), ' ') AS only_b
      FROM (SELECT *, list_sort(list_distinct({E.tokens('a_key')})) AS ta,
                      list_sort(list_distinct({E.tokens('b_key')})) AS tb FROM {pairs})
    )
  )
)"""


TOP_K = f"""
SELECT * EXCLUDE (rk) FROM (
  SELECT *, row_number() OVER (PARTITION BY b_row_id ORDER BY token_set DESC, a_row_id) AS rk
  FROM ({token_set('block_pairs', 'a_row_id, b_row_id, a_key, b_key')})
) WHERE rk <= 5"""

CANDIDATES = f"""
SELECT *, {E.ratio("array_to_string(" + E.tokens('a_key') + ", ' ')", "array_to_string(" + E.tokens('b_key') + ", ' ')")} AS token_sort,
  {E.ratio('a_key', 'b_key')} AS ratio
FROM top_k"""

FUZZY = _resolved(
    "SELECT * FROM ("
    + _scored(
        "candidates c JOIN rest2_a a ON a.row_id = c.a_row_id JOIN rest2_b b ON b.row_id = c.b_row_id",
        "greatest(c.token_set, c.token_sort, c.ratio)", "fuzzy_blocked",
    )
    + ") WHERE match_status <> 'no_match'"
)

_CONFLICT = "coalesce(abs({0} - {1}) > {2}, false)"
_SA, _SB = E.genre_set("a.genres_list_tmdb"), E.genre_set("b.genres_list_imdb")
CONFLICT_GENRE = f"(len({_SA}) > 0 AND len({_SB}) > 0 AND len(list_intersect({_SA}, {_SB})) = 0)"


def union_genres(a: str, b: str) -> str:
    everything = f"list_filter(list_transform(list_concat({a}, {b}), lambda ug: trim(ug)), lambda uf: uf <> '' AND lower(uf) <> 'unknown')"
    return E.or_unknown(E.ordered_distinct(everything))


def weighted_rating(ra: str, va: str, rb: str, vb: str) -> str:
    wa, wb = (f"(CASE WHEN {v} > 0 THEN {v} ELSE 1.0::double END)" for v in (va, vb))
    return f"coalesce(({ra} * {wa} + {rb} * {wb}) / ({wa} + {wb}), {ra}, {rb})"


def profit(part: str, b: str = "a.budget_usd", r: str = "a.revenue_usd") -> str:
    known = f"{b} > 0 AND {r} IS NOT NULL"
    value = {
        "profit": f"{r} - {b}",
        "roi": f"({r} - {b}) / {b}",
        "is_profitable": f"({r} > {b})::int::double",
    }[part]
    return f"(CASE WHEN {known} THEN {value} END)"


RATING = weighted_rating("a.vote_average_tmdb", "a.vote_count_tmdb", "b.rating_imdb", "b.user_rating_count_imdb")

_FROM_A = f"""
SELECT 'merged' AS record_type, a.a_row_id AS source_row_id, a.tmdb_id, b.imdb_path, 2 AS source_count,
  'tmdb|imdb' AS source_trace,
  CASE WHEN {E.missing_text('a.title_display_tmdb')} THEN b.title_display_imdb ELSE a.title_display_tmdb END AS title_display,
  a.title_display_tmdb, b.title_display_imdb, coalesce(a.title_norm, b.title_norm) AS title_norm,
  coalesce(a.release_date, b.release_date) AS release_date, coalesce(a.release_year, b.release_year) AS release_year,
  coalesce(a.release_decade, b.release_decade) AS release_decade,
  a.release_year AS release_year_tmdb, b.release_year AS release_year_imdb,
  {_CONFLICT.format('a.release_year', 'b.release_year', 1)} AS year_conflict,
  coalesce(a.runtime_min, b.runtime_min) AS runtime_min, a.runtime_min AS runtime_tmdb, b.runtime_min AS runtime_imdb,
  {_CONFLICT.format('a.runtime_min', 'b.runtime_min', 10)} AS runtime_conflict,
  a.budget_usd, a.revenue_usd, a.budget_observed, a.revenue_observed, a.budget_was_zero, a.revenue_was_zero,
  {profit('profit')} AS profit_usd, {profit('roi')} AS roi, {profit('is_profitable')} AS is_profitable,
  a.vote_average_tmdb, a.vote_count_tmdb, a.popularity_tmdb, b.rating_imdb, b.user_rating_count_imdb,
  {RATING} AS rating_normalized,
  {_CONFLICT.format('a.vote_average_tmdb', 'b.rating_imdb', 2.0)} AS rating_conflict,
  {union_genres('a.genres_list_tmdb', 'b.genres_list_imdb')} AS genres_list,
  {CONFLICT_GENRE} AS genre_conflict,
  a.original_language_clean AS original_language, a.origin_country_clean AS origin_country,
  b.director, b.writer, b."cast", b.overview, b.keywords, a.production_companies, a.adult,
  m.linkage_score, m.match_status AS linkage_status, m.match_method,
  false AS title_missing, coalesce(a.year_out_of_range, false) OR coalesce(b.year_out_of_range, false) AS year_out_of_range,
  a.runtime_out_of_range, {RATING} IS NULL AS rating_missing
FROM strong m JOIN clean_a a ON a.a_row_id = m.a_row_id JOIN clean_b b ON b.b_row_id = m.b_row_id"""

_A_ONLY = f"""
SELECT 'tmdb_only', a.a_row_id, a.tmdb_id, NULL, 1, 'tmdb', a.title_display_tmdb, NULL, NULL, a.title_norm,
  a.release_date, a.release_year, a.release_decade, NULL, NULL, NULL, a.runtime_min, NULL, NULL, NULL,
  a.budget_usd, a.revenue_usd, a.budget_observed, a.revenue_observed, a.budget_was_zero, a.revenue_was_zero,
  {profit('profit')}, {profit('roi')}, {profit('is_profitable')},
  a.vote_average_tmdb, a.vote_count_tmdb, a.popularity_tmdb, NULL, NULL, a.vote_average_tmdb, NULL,
  a.genres_list_tmdb, NULL, a.original_language_clean, a.origin_country_clean, NULL, NULL, NULL, NULL, NULL,
  a.production_companies, a.adult, NULL, 'no_match', 'no_match', a.title_missing,
  coalesce(a.year_out_of_range, false), a.runtime_out_of_range, a.rating_missing
FROM clean_a a WHERE a.a_row_id NOT IN (SELECT a_row_id FROM strong)"""

_B_ONLY = """
SELECT 'imdb_only', b.b_row_id, NULL, b.imdb_path, 1, 'imdb', b.title_display_imdb, NULL, NULL, b.title_norm,
  b.release_date, b.release_year, b.release_decade, NULL, NULL, NULL, b.runtime_min, NULL, NULL, NULL,
  NULL, NULL, false, false, false, false, NULL, NULL, NULL,
  NULL, NULL, NULL, b.rating_imdb, b.user_rating_count_imdb, b.rating_imdb, NULL,
  b.genres_list_imdb, NULL, NULL, NULL, b.director, b.writer, b."cast", b.overview, b.keywords,
  NULL, NULL, NULL, 'no_match', 'no_match', b.title_missing,
  coalesce(b.year_out_of_range, false), NULL, b.rating_missing
FROM clean_b b WHERE b.b_row_id NOT IN (SELECT b_row_id FROM strong)"""


def _mean(conditions: list[str]) -> str:
    return "(" + " + ".join(f"({c})::int" for c in conditions) + f") / {len(conditions)}"


_COMPLETE = _mean(
    [f"NOT {E.missing_text(c)}" for c in ("title_display", "genres_canonical")]
    + [f"{c} IS NOT NULL" for c in ("release_year", "runtime_min", "rating_normalized", "budget_usd", "revenue_usd")]
)
_VALID = _mean([f"NOT coalesce({c}, false)" for c in (
    "title_missing", "year_out_of_range", "runtime_out_of_range", "rating_missing", "genres_missing")])
_CONSISTENT = _mean([f"NOT coalesce({c}, false)" for c in (
    "runtime_conflict", "rating_conflict", "genre_conflict", "year_conflict")])

MASTER_PLAIN = f"""
SELECT *, round(co, 4) AS completeness_score, round(va, 4) AS validity_score, round(cs, 4) AS consistency_score,
  1.0::double AS uniqueness_score, 1.0::double AS traceability_score,
  round(0.35::double * co + 0.25::double * va + 0.20::double * cs + 0.10::double * 1.0 + 0.10::double * 1.0, 4) AS data_quality_score
FROM (
  SELECT *, {_COMPLETE} AS co, {_VALID} AS va, {_CONSISTENT} AS cs FROM (
    SELECT printf('M_%07d', row_number() OVER (ORDER BY
        CASE record_type WHEN 'merged' THEN 1 WHEN 'tmdb_only' THEN 2 ELSE 3 END, source_row_id)) AS movie_master_id,
      *, array_to_string(genres_list, ', ') AS genres_canonical, genres_list = ['Unknown'] AS genres_missing
    FROM ({_FROM_A} UNION ALL {_A_ONLY} UNION ALL {_B_ONLY})
  )
)"""

IQR_COLUMNS = ("runtime_min", "budget_usd", "revenue_usd", "popularity_tmdb", "vote_count_tmdb", "roi")

BOUNDS = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3, "
    f"quantile_cont({c}, 0.25) - 1.5::double * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lower_bound, "
    f"quantile_cont({c}, 0.75) + 1.5::double * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS upper_bound "
    f"FROM master_plain" for c in IQR_COLUMNS
)

MASTER = (
    "SELECT *, " + " OR ".join(f"{c}_outlier_iqr" for c in IQR_COLUMNS) + " AS any_outlier_flag FROM (SELECT *, "
    + ", ".join(
        f"coalesce({c} < (SELECT lower_bound FROM bounds WHERE \"column\" = '{c}') "
        f"OR {c} > (SELECT upper_bound FROM bounds WHERE \"column\" = '{c}'), false) AS {c}_outlier_iqr"
        for c in IQR_COLUMNS
    )
    + " FROM master_plain)"
)

TABLES: dict[str, str] = {
    "cat_a": catalog_sql("cat_a"),
    "cat_b": catalog_sql("cat_b"),
    "clean_a": CLEAN_A,
    "clean_b": CLEAN_B,
    "link_a": _link("a", "clean_a", "tmdb_id", "title_display_tmdb", "genres_list_tmdb"),
    "link_b": _link("b", "clean_b", "imdb_path", "title_display_imdb", "genres_list_imdb"),
    "exact": EXACT,
    "rest1_a": REST.format(table="link_a", side="a", matched="exact"),
    "rest1_b": REST.format(table="link_b", side="b", matched="exact"),
    "pm1": PM1,
    "rest2_a": REST.format(table="rest1_a", side="a", matched="pm1"),
    "rest2_b": REST.format(table="rest1_b", side="b", matched="pm1"),
    "block_pairs": BLOCK_PAIRS,
    "top_k": TOP_K,
    "candidates": CANDIDATES,
    "fuzzy": FUZZY,
    "matches": "SELECT * FROM exact UNION ALL SELECT * FROM pm1",
    "matches_all": "SELECT * FROM matches UNION ALL SELECT * FROM fuzzy",
    "strong": "SELECT * FROM matches_all WHERE match_status = 'strong_match'",
    "truth": "SELECT a.*, b.* FROM clean_a a JOIN clean_b b ON a.a_row_id = b.b_row_id % 1000000000",
    "master_plain": MASTER_PLAIN,
    "bounds": BOUNDS,
    "master": MASTER,
}


def query(final: str, **extra: str) -> str:
    """The final statement with every named subquery it needs, directly or not."""
    known = TABLES | extra
    needed: dict[str, None] = {}

    def visit(sql: str) -> None:
        for name in re.findall(r"\b(?:FROM|JOIN)\s+\(?\s*([a-z_0-9]+)\b", sql):
            if name in known and name not in needed:
                visit(known[name])
                needed[name] = None

    visit(final)
    if not needed:
        return final
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({known[n].strip()})" for n in needed)
    return f"WITH {ctes}\n{final}"
