"""Every registered query with the SQL that must give the same rows (None: rows only)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from fusework.functions import indel, lists as L, parse as P, similarity as S, text as X
from fusework.operators import (
    audit, clean, dedup, golden, link, models, outliers, profile, quality, ranking, recommend, reports,
)
from fusework.operators.quantiles import exact_quantiles
from fusework.plans.stages import run_stages
from fusework.session import StageStore
from fusework.sources import catalog_csv as csv
from fusework.sources.fixtures import cat_a, cat_b, table
from oracles import expressions as E
from oracles.context import flat, full_run, sql_run, truth_pairs
from oracles.tables import IQR_COLUMNS, query, token_set, union_genres, weighted_rating, profit, CONFLICT_GENRE

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
C = F.col


def register(name: str, sql: str | None = None, **extra: str) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = query(sql, **extra)
        return fn

    return add


# --- sources and sinks ---------------------------------------------------------------------------

_CSV_COLUMNS = (
    "path", "movie_title", "year", "run_time", "rating", "user_rating", "generes", "director", "overview",
    "plot_kyeword", "top_5_casts", "writer",
)


@register(
    "load_csv_source",
    "SELECT cast(row_id AS varchar) AS row_id, "
    + ", ".join(f"{E.na_to_null(c)} AS {c}" for c in _CSV_COLUMNS)
    + ", 'imdb' AS _source FROM cat_b",
)
def load_csv_source(spark, sf_dir):
    df = cat_b(spark, sf_dir).drop("src_key")
    names = [c.replace("_", " ").title() for c in df.columns]
    path = csv.write_table(df.toDF(*names), StageStore(spark).path("csv"), fmt="csv")
    return csv.load_csv_source(spark, path, "imdb", backslash_escapes=True)


@register(
    "snake_case_columns",
    "SELECT o_orderstatus AS order_status, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total_price "
    "FROM orders GROUP BY 1",
)
def snake_case_columns(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select(
        C("o_orderkey").alias(" Order-Key!"), C("o_orderstatus").alias("Order  Status"),
        C("o_totalprice").alias("Total Price"),
    )
    named = csv.snake_case_columns(df)
    return named.groupBy("order_status").agg(
        F.count("order_key").alias("n_orders"), F.round(F.sum("total_price"), 2).alias("total_price")
    )


@register(
    "write_table",
    "SELECT o_orderstatus, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total_price FROM orders GROUP BY 1",
)
def write_table(spark, sf_dir):
    path = csv.write_table(
        table(spark, sf_dir, "orders"), StageStore(spark).path("orders"), partition_by=("o_orderstatus",)
    )
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total_price")
    )


@register("reload_master", "SELECT record_type, count(*) AS n FROM master GROUP BY 1")
def reload_master(spark, sf_dir):
    run = sql_run(spark, sf_dir)
    run.master
    return csv.reload_master(spark, run.store.path("master")).groupBy("record_type").agg(F.count(F.lit(1)).alias("n"))


@register(
    "reload_clean_inputs",
    "SELECT 'clean_a' AS name, count(*) AS n FROM clean_a UNION ALL SELECT 'clean_b', count(*) FROM clean_b "
    "UNION ALL SELECT 'matches', count(*) FROM matches_all",
)
def reload_clean_inputs(spark, sf_dir):
    run = sql_run(spark, sf_dir)
    root = StageStore(spark)
    for name, df in (("clean_a", run.clean_a), ("clean_b", run.clean_b), ("matches", run.matches)):
        csv.write_table(df, root.path(name))
    parts = zip(("clean_a", "clean_b", "matches"), csv.reload_clean_inputs(spark, root.root))
    counts = [d.agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n")) for n, d in parts]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@register(
    "write_match_audit",
    "SELECT match_status, match_method, count(*) AS n, round(avg(linkage_score), 6) AS mean_score "
    "FROM matches_all GROUP BY 1, 2",
)
def write_match_audit(spark, sf_dir):
    path = csv.write_match_audit(sql_run(spark, sf_dir).matches, StageStore(spark).path("audit"))
    return spark.read.parquet(path).groupBy("match_status", "match_method").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("linkage_score"), 6).alias("mean_score")
    )


# --- text and lists ------------------------------------------------------------------------------


@register("strip_accents", "SELECT doc_id, md5(strip_accents(text)) AS plain FROM documents")
def strip_accents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(X.strip_accents(C("text"))).alias("plain"))


@register(
    "normalize_basic_text",
    f"SELECT doc_id, md5(k) AS plain, length(k) AS n FROM (SELECT doc_id, {E.basic_text('text')} AS k FROM documents)",
)
def normalize_basic_text(spark, sf_dir):
    keyed = table(spark, sf_dir, "documents").select("doc_id", X.normalize_basic_text(C("text")).alias("k"))
    return keyed.select("doc_id", F.md5("k").alias("plain"), F.length("k").cast("bigint").alias("n"))


@register("normalize_title", f"SELECT row_id, {E.title_key('movie_title')} AS title_norm FROM cat_b")
def normalize_title(spark, sf_dir):
    return cat_b(spark, sf_dir).select("row_id", X.normalize_title(C("movie_title")).alias("title_norm"))


def _listed(x: str, brackets: bool = True) -> str:
    return f"SELECT row_id, array_to_string(l, '|') AS items, len(l)::int AS n FROM (SELECT row_id, {E.parsed_list(x, brackets)} AS l FROM "


@register("parse_list_field", _listed("genre_names") + "cat_a)")
def parse_list_field(spark, sf_dir):
    parsed = cat_a(spark, sf_dir).select("row_id", L.parse_list_field(C("genre_names")).alias("l"))
    return parsed.select("row_id", F.array_join("l", "|").alias("items"), F.size("l").alias("n"))


@register("ensure_list", _listed("generes", False) + "cat_b)")
def ensure_list(spark, sf_dir):
    parsed = cat_b(spark, sf_dir).select("row_id", L.ensure_list(C("generes")).alias("l"))
    return parsed.select("row_id", F.array_join("l", "|").alias("items"), F.size("l").alias("n"))


@register(
    "normalize_genre",
    f"SELECT g AS raw, {E.genre('g')} AS genre, count(*) AS n FROM "
    f"(SELECT unnest({E.parsed_list('genre_names')}) AS g FROM cat_a) GROUP BY 1, 2",
)
def normalize_genre(spark, sf_dir):
    items = cat_a(spark, sf_dir).select(F.explode(L.parse_list_field(C("genre_names"))).alias("raw"))
    # few distinct texts: counted first, normalized once each
    counts = items.groupBy("raw").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("raw", X.normalize_genre(C("raw")).alias("genre"), "n")


@register(
    "normalize_genres",
    "SELECT a_row_id, array_to_string(genres_list_tmdb, '|') AS genres FROM clean_a",
)
def normalize_genres(spark, sf_dir):
    one = dedup.dedup_by_key(cat_a(spark, sf_dir).select("id", "row_id", "genre_names"), "id", "row_id")
    return one.select(
        C("row_id").alias("a_row_id"),
        F.array_join(X.normalize_genres(L.parse_list_field(C("genre_names"))), "|").alias("genres"),
    )


@register("join_list", f"SELECT row_id, array_to_string({E.parsed_list('genre_names')}, ', ') AS joined FROM cat_a")
def join_list(spark, sf_dir):
    return cat_a(spark, sf_dir).select("row_id", L.join_list(L.parse_list_field(C("genre_names"))).alias("joined"))


@register("clean_code_column", "SELECT row_id, lower(trim(original_language)) AS code FROM cat_a")
def clean_code_column(spark, sf_dir):
    return cat_a(spark, sf_dir).select("row_id", X.clean_code(C("original_language")).alias("code"))


@register(
    "fill_blank_text",
    "SELECT row_id, trim(coalesce(overview, '')) AS overview, trim(coalesce(generes, '')) AS generes FROM cat_b",
)
def fill_blank_text(spark, sf_dir):
    return cat_b(spark, sf_dir).select("row_id", *[X.fill_blank_text(C(c)).alias(c) for c in ("overview", "generes")])


@register("block_key_first_letter", f"SELECT row_id, substr({E.title_key('movie_title')}, 1, 1) AS letter FROM cat_b")
def block_key_first_letter(spark, sf_dir):
    return cat_b(spark, sf_dir).select(
        "row_id", X.block_key_first_letter(X.normalize_title(C("movie_title"))).alias("letter")
    )


@register("main_title_token", f"SELECT row_id, string_split({E.title_key('movie_title')}, ' ')[1] AS token FROM cat_b")
def main_title_token(spark, sf_dir):
    return cat_b(spark, sf_dir).select(
        "row_id", X.main_title_token(X.normalize_title(C("movie_title"))).alias("token")
    )


# --- typed fields --------------------------------------------------------------------------------


@register(
    "parse_runtime",
    f"SELECT row_id, {E.runtime_minutes('run_time')} AS minutes, {E.runtime_status('run_time')} AS status FROM cat_b",
)
def parse_runtime(spark, sf_dir):
    parsed = cat_b(spark, sf_dir).select("row_id", P.parse_runtime(C("run_time")).alias("r"))
    return parsed.select("row_id", "r.minutes", "r.status")


@register(
    "parse_money",
    " UNION ALL ".join(
        f"SELECT row_id, '{c}' AS field, {E.money_value(c)} AS value, "
        f"{E.money_status(c)} = 'zero_as_missing' AS was_zero, {E.money_status(c)} AS status FROM cat_a"
        for c in ("budget", "revenue")
    ),
)
def parse_money(spark, sf_dir):
    raw = cat_a(spark, sf_dir)
    long = raw.unpivot(["row_id"], ["budget", "revenue"], "field", "text")
    parsed = long.select("row_id", "field", P.parse_money(C("text")).alias("m"))
    return parsed.select("row_id", "field", "m.value", "m.was_zero", "m.status")


@register("parse_count_suffix", f"SELECT row_id, {E.count_suffix('user_rating')} AS n FROM cat_b")
def parse_count_suffix(spark, sf_dir):
    return cat_b(spark, sf_dir).select("row_id", P.parse_count_suffix(C("user_rating")).alias("n"))


@register(
    "clean_year",
    f"SELECT row_id, CASE WHEN y BETWEEN 1900 AND 2026 THEN y::int END AS clean_year "
    f"FROM (SELECT row_id, floor(abs({E.number('year')})) AS y FROM cat_b)",
)
def clean_year(spark, sf_dir):
    return cat_b(spark, sf_dir).select("row_id", P.clean_year(C("year")).alias("clean_year"))


@register("numeric_coerce", f"SELECT row_id, {E.number('rating')} AS rating FROM cat_b")
def numeric_coerce(spark, sf_dir):
    return cat_b(spark, sf_dir).select("row_id", P.numeric_coerce(C("rating")).alias("rating"))


@register(
    "parse_date_year_decade",
    f"SELECT row_id, cast(d AS varchar) AS release_date, cast(year(d) AS integer) AS release_year, "
    f"{E.decade('year(d)')} AS release_decade, d IS NULL AS year_missing, "
    f"coalesce(year(d) < 1900 OR year(d) > 2026, false) AS year_out_of_range "
    f"FROM (SELECT row_id, {E.date('release_date')} AS d FROM cat_a)",
)
def parse_date_year_decade(spark, sf_dir):
    parsed = cat_a(spark, sf_dir).select("row_id", P.parse_date(C("release_date")).alias("release_date"))
    year = F.year("release_date")
    return flat(parsed.select(
        "row_id", "release_date", year.alias("release_year"), P.decade(year).alias("release_decade"),
        year.isNull().alias("year_missing"), P.safe_bool(P.year_out_of_range(year)).alias("year_out_of_range"),
    ))


@register(
    "repair_negative_year",
    f"SELECT row_id, cast(abs(y) AS integer) AS release_year, y < 0 AS year_was_negative, "
    f"cast(make_date(cast(abs(y) AS integer), 1, 1) AS varchar) AS release_date, {E.decade('abs(y)')} AS release_decade "
    f"FROM (SELECT row_id, {E.number('year')} AS y FROM cat_b)",
)
def repair_negative_year(spark, sf_dir):
    fixed = cat_b(spark, sf_dir).select("row_id", P.repair_negative_year(P.numeric_coerce(C("year"))).alias("r"))
    return flat(fixed.select(
        "row_id", C("r.year").alias("release_year"), C("r.was_negative").alias("year_was_negative"),
        P.first_day_of_year(C("r.year")).alias("release_date"), P.decade(C("r.year")).alias("release_decade"),
    ))


@register(
    "runtime_range_guard",
    "SELECT a_row_id, runtime_min, runtime_was_zero, runtime_out_of_range, runtime_missing FROM clean_a",
)
def runtime_range_guard(spark, sf_dir):
    one = dedup.dedup_by_key(cat_a(spark, sf_dir).select("id", "row_id", "runtime"), "id", "row_id")
    guarded = one.select(
        C("row_id").alias("a_row_id"), P.runtime_range_guard(P.numeric_coerce(C("runtime"))).alias("g")
    )
    return guarded.select(
        "a_row_id", C("g.minutes").alias("runtime_min"), C("g.was_zero").alias("runtime_was_zero"),
        C("g.out_of_range").alias("runtime_out_of_range"), C("g.missing").alias("runtime_missing"),
    )


@register(
    "zero_vote_guard",
    "SELECT a_row_id, vote_average_tmdb, vote_average_zero, vote_count_zero FROM clean_a",
)
def zero_vote_guard(spark, sf_dir):
    one = dedup.dedup_by_key(
        cat_a(spark, sf_dir).select("id", "row_id", "vote_average", "vote_count"), "id", "row_id"
    )
    guarded = one.select(
        C("row_id").alias("a_row_id"),
        P.zero_vote_guard(P.numeric_coerce(C("vote_average")), P.numeric_coerce(C("vote_count"))).alias("g"),
    )
    return guarded.select(
        "a_row_id", C("g.rating").alias("vote_average_tmdb"), C("g.rating_zero").alias("vote_average_zero"),
        C("g.votes_zero").alias("vote_count_zero"),
    )


@register(
    "rating_range_guard",
    f"SELECT row_id, r AS rating, r IS NULL AS rating_missing FROM (SELECT row_id, "
    f"CASE WHEN {E.number('rating')} BETWEEN 0 AND 10 THEN {E.number('rating')} END AS r FROM cat_b)",
)
def rating_range_guard(spark, sf_dir):
    rated = cat_b(spark, sf_dir).select("row_id", P.rating_range_guard(P.numeric_coerce(C("rating"))).alias("rating"))
    return rated.withColumn("rating_missing", C("rating").isNull())


_MONEY_COLUMNS = [f"{m}_{c}" for m in ("budget", "revenue") for c in ("usd", "was_zero", "parse_status", "missing", "observed")]


@register("observed_flags", f"SELECT a_row_id, {', '.join(_MONEY_COLUMNS)} FROM clean_a")
def observed_flags(spark, sf_dir):
    return sql_run(spark, sf_dir).clean_a.select("a_row_id", *_MONEY_COLUMNS)


@register(
    "clean_catalog_a",
    "SELECT * REPLACE (cast(release_date AS varchar) AS release_date, array_to_string(genres_list_tmdb, '|') AS genres_list_tmdb) FROM clean_a",
)
def clean_catalog_a(spark, sf_dir):
    return flat(clean.clean_catalog_a(cat_a(spark, sf_dir)))


@register(
    "clean_catalog_b",
    "SELECT * REPLACE (cast(release_date AS varchar) AS release_date, array_to_string(genres_list_imdb, '|') AS genres_list_imdb) FROM clean_b",
)
def clean_catalog_b(spark, sf_dir):
    return flat(clean.clean_catalog_b(cat_b(spark, sf_dir)))


@register(
    "is_missing",
    f"SELECT row_id, {E.missing_text('movie_title')} AS title_missing, {E.missing_text('generes')} AS genres_text_missing, "
    f"{E.number('rating')} IS NULL AS rating_missing, "
    f"len(gl) = 0 OR gl = ['Unknown'] AS list_missing FROM (SELECT *, {E.parsed_list('generes')} AS gl FROM cat_b)",
)
def is_missing(spark, sf_dir):
    return cat_b(spark, sf_dir).select(
        "row_id",
        P.is_missing_text(C("movie_title")).alias("title_missing"),
        P.is_missing_text(C("generes")).alias("genres_text_missing"),
        P.is_missing_number(P.numeric_coerce(C("rating"))).alias("rating_missing"),
        P.is_missing_list(L.parse_list_field(C("generes"))).alias("list_missing"),
    )


@register(
    "safe_bool",
    "SELECT a_row_id, coalesce(year_out_of_range, false) AS or_false, coalesce(year_out_of_range, true) AS or_true FROM clean_a",
)
def safe_bool(spark, sf_dir):
    flag = C("year_out_of_range")
    return sql_run(spark, sf_dir).clean_a.select(
        "a_row_id", P.safe_bool(flag).alias("or_false"), P.safe_bool(flag, True).alias("or_true")
    )


# --- deduplication -------------------------------------------------------------------------------


@register(
    "dedup_by_key",
    "SELECT * EXCLUDE (rn) FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, "
    "row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn "
    "FROM lineitem) WHERE rn = 1",
)
def dedup_by_key(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    return dedup.keep_first(
        rows, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    )


@register("dedup_texts", "SELECT min(doc_id) AS doc_id, md5(text) AS text_md5 FROM documents GROUP BY text")
def dedup_texts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", dedup.text_digest(C("text")).alias("digest"), F.md5("text").alias("text_md5")
    )
    return dedup.dedup_by_key(docs, "digest", "doc_id").drop("digest")


@register("dedup_best_record", "SELECT b_row_id, title_norm, release_year FROM clean_b")
def dedup_best_record(spark, sf_dir):
    return clean.clean_catalog_b(cat_b(spark, sf_dir)).select("b_row_id", "title_norm", "release_year")


@register(
    "count_duplicates",
    " UNION ALL ".join(
        f"SELECT '{t}' AS name, sum(n)::bigint AS n_rows, count(*) AS n_distinct, (sum(n) - count(*))::bigint AS n_duplicates "
        f"FROM (SELECT count(*) AS n FROM {t} GROUP BY {g})"
        for t, g in (("documents", "text"), ("lineitem", "l_orderkey, l_linenumber"), ("orders", "ALL"), ("cat_a", "id"))
    ).replace("SELECT count(*) AS n FROM orders GROUP BY ALL", "SELECT count(*) AS n, * FROM orders GROUP BY ALL"),
)
def count_duplicates(spark, sf_dir):
    cases = [
        ("documents", table(spark, sf_dir, "documents").select(dedup.text_digest(C("text")).alias("text")), ["text"]),
        ("lineitem", table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]),
        ("orders", table(spark, sf_dir, "orders"), None),
        ("cat_a", cat_a(spark, sf_dir), ["id"]),
    ]
    out = None
    for name, df, keys in cases:
        one = dedup.count_duplicates(df, keys).select(F.lit(name).alias("name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


# --- profiling -----------------------------------------------------------------------------------

_PROFILED = {
    "lineitem": {
        "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
        "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
        "l_returnflag": "string", "l_linestatus": "string",
    },
    "orders": {
        "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
        "o_orderpriority": "string",
    },
    "events": {
        "event_id": "bigint", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string",
    },
}


def _profile_sql(source: str, name: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{source}' AS source, '{c}' AS \"column\", '{t}' AS dtype, count(*) AS n_rows, "
        f"count(*) - count({c}) AS n_null, round((count(*) - count({c}))::double / count(*) * 100, 4) AS null_pct, "
        f"count({c}) AS n_not_null, count(DISTINCT {c}) AS n_unique, "
        f"CASE WHEN count({c}) > 0 THEN round(count(DISTINCT {c})::double / count({c}) * 100, 4) END AS unique_pct_over_not_null "
        f"FROM {name}"
        for c, t in columns.items()
    )


@register("profile_columns", " UNION ALL ".join(_profile_sql(n, n, c) for n, c in _PROFILED.items()))
def profile_columns(spark, sf_dir):
    reports_ = [
        profile.profile_columns(table(spark, sf_dir, n).select(*c), n) for n, c in _PROFILED.items()
    ]
    return reports_[0].unionByName(reports_[1]).unionByName(reports_[2])


_CAT_A = {
    "id": "string", "title": "string", "release_date": "string", "runtime": "string", "budget": "string",
    "revenue": "string", "vote_average": "double", "popularity": "double", "genre_names": "string",
    "original_language": "string",
}


@register("profile_raw_catalog", _profile_sql("tmdb", "cat_a", _CAT_A))
def profile_raw_catalog(spark, sf_dir):
    return profile.profile_columns(cat_a(spark, sf_dir).select(*_CAT_A), "tmdb")


def _metrics_sql(pairs: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS metric, ({e})::double AS value FROM {source}" for n, e in pairs.items())


_DIAG_A = _metrics_sql(
    {
        "n_rows": "count(*)", "n_cols": "max(11)",
        "runtime_null": f"count_if({E.number('runtime')} IS NULL)",
        "runtime_zero": f"count_if({E.number('runtime')} = 0)",
        "runtime_gt_600": f"count_if({E.number('runtime')} > 600)",
        "revenue_negative": f"count_if({E.number('revenue')} < 0)", "revenue_zero": f"count_if({E.number('revenue')} = 0)",
        "budget_negative": f"count_if({E.number('budget')} < 0)", "budget_zero": f"count_if({E.number('budget')} = 0)",
        "vote_average_zero": "count_if(vote_average = 0)",
        "vote_average_out_of_range": "count_if(vote_average < 0 OR vote_average > 10)",
        "vote_count_zero": "count_if(vote_count = 0)",
        "duplicated_id": "count(*) - count(DISTINCT id)",
    },
    "cat_a",
) + (
    " UNION ALL SELECT 'duplicated_rows', (sum(n) - count(*))::double FROM (SELECT count(*) AS n FROM (SELECT * EXCLUDE (row_id) FROM cat_a) GROUP BY "
    + ", ".join(f"{c}" for c in [*_CAT_A, "vote_count"]) + ")"
    f" UNION ALL SELECT 'duplicated_title_year', (sum(n) - count(*))::double FROM (SELECT count(*) AS n FROM cat_a "
    f"GROUP BY {E.basic_text('title')}, year({E.date('release_date')}))"
)
_DIAG_B = _metrics_sql(
    {
        "n_rows": "count(*)", "n_cols": "max(12)", "year_negative": "count_if(year < 0)",
        "run_time_missing": "count_if(run_time IS NULL)",
        "run_time_not_released": "count_if(lower(run_time) LIKE '%not-released%')",
        "run_time_contains_money": "count_if(run_time LIKE '%$%')",
        "rating_not_numeric": f"count_if({E.number('rating')} IS NULL)",
        "rating_out_of_range": f"count_if({E.number('rating')} < 0 OR {E.number('rating')} > 10)",
    },
    "cat_b",
) + (
    " UNION ALL SELECT 'duplicated_rows', (sum(n) - count(*))::double FROM (SELECT count(*) AS n FROM cat_b GROUP BY "
    + ", ".join(_CSV_COLUMNS) + ")"
    f" UNION ALL SELECT 'duplicated_title_year', (sum(n) - count(*))::double FROM (SELECT count(*) AS n FROM cat_b "
    f"GROUP BY {E.basic_text('movie_title')}, abs(year))"
)


@register("diagnose_catalog_a", _DIAG_A)
def diagnose_catalog_a(spark, sf_dir):
    return profile.diagnose_catalog_a(cat_a(spark, sf_dir))


@register("diagnose_catalog_b", _DIAG_B)
def diagnose_catalog_b(spark, sf_dir):
    return profile.diagnose_catalog_b(cat_b(spark, sf_dir))


@register(
    "initial_issues_comparison",
    "SELECT i.issue, round(100 * coalesce(a.value, 0) / (SELECT value FROM diag_a WHERE metric = 'n_rows'), 4) AS pct_a, "
    "round(100 * b.value / (SELECT value FROM diag_b WHERE metric = 'n_rows'), 4) AS pct_b FROM (VALUES "
    "('title', 'duplicated_title_year', 'duplicated_title_year'), ('year', NULL, 'year_negative'), "
    "('runtime', 'runtime_zero', 'run_time_not_released'), ('rating', 'vote_count_zero', 'rating_not_numeric')) "
    "i(issue, ma, mb) LEFT JOIN diag_a a ON a.metric = i.ma LEFT JOIN diag_b b ON b.metric = i.mb",
    diag_a=_DIAG_A, diag_b=_DIAG_B,
)
def initial_issues_comparison(spark, sf_dir):
    return profile.initial_issues_comparison(
        profile.diagnose_catalog_a(cat_a(spark, sf_dir)), profile.diagnose_catalog_b(cat_b(spark, sf_dir))
    )


@register(
    "summarize_table",
    "SELECT 'cat_b' AS label, count(*) AS n_rows, 14 AS n_cols, "
    + " + ".join(f"count_if({c} IS NULL)" for c in _CSV_COLUMNS)
    + " AS null_cells FROM cat_b UNION ALL SELECT 'orders', count(*), 6, 0 FROM orders",
)
def summarize_table(spark, sf_dir):
    return profile.summarize_table(cat_b(spark, sf_dir), "cat_b").unionByName(
        profile.summarize_table(table(spark, sf_dir, "orders"), "orders")
    )


@register(
    "top_value_counts",
    "SELECT run_time AS value, count(*) AS count, round(count(*)::double / (SELECT count(*) FROM cat_b) * 100, 2) AS pct "
    "FROM cat_b GROUP BY 1 ORDER BY 2 DESC, 1 NULLS LAST LIMIT 10",
)
def top_value_counts(spark, sf_dir):
    return profile.top_value_counts(cat_b(spark, sf_dir), "run_time")


@register(
    "top_value_counts_events",
    "SELECT user_id AS value, count(*) AS count, round(count(*)::double / (SELECT count(*) FROM events) * 100, 2) AS pct "
    "FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20",
)
def top_value_counts_events(spark, sf_dir):
    return profile.top_value_counts(table(spark, sf_dir, "events"), "user_id", 20)


@register(
    "cleaning_summary",
    " UNION ALL ".join(
        f"SELECT '{label}' AS source, (SELECT count(*) FROM cat_{s}) AS rows_raw, count(*) AS rows_clean, "
        f"(SELECT count(*) FROM cat_{s}) - count(*) AS rows_removed, "
        + ", ".join(
            f"count_if({f}) AS {f}"
            for f in ("title_missing", "year_missing", "runtime_missing", "rating_missing", "genres_missing")
        )
        + f" FROM clean_{s}"
        for s, label in (("a", "tmdb"), ("b", "imdb"))
    ),
)
def cleaning_summary(spark, sf_dir):
    run = sql_run(spark, sf_dir)
    return clean.cleaning_summary(run.raw_a, run.raw_b, run.clean_a, run.clean_b)


def _null_pct_sql(columns, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(avg((\"{c}\" IS NULL)::int) * 100, 4) AS null_pct FROM {source}" for c in columns
    )


@register("null_pct_columns", _null_pct_sql(audit.NULL_REPORT_COLUMNS, "master"))
def null_pct_columns(spark, sf_dir):
    return profile.null_pct_columns(sql_run(spark, sf_dir).master, audit.NULL_REPORT_COLUMNS)


# --- record linkage ------------------------------------------------------------------------------


@register("runtime_similarity", f"SELECT b_row_id, {E.runtime_sim('a.runtime_min', 'b.runtime_min')} AS runtime_similarity FROM clean_a a JOIN clean_b b ON a.a_row_id = b.b_row_id % 1000000000")
def runtime_similarity(spark, sf_dir):
    return truth_pairs(sql_run(spark, sf_dir)).select(
        "b_row_id", S.runtime_similarity(C("a.runtime_min"), C("b.runtime_min")).alias("runtime_similarity")
    )


@register("year_similarity", f"SELECT b_row_id, {E.year_sim('a.release_year', 'b.release_year')} AS year_similarity FROM clean_a a JOIN clean_b b ON a.a_row_id = b.b_row_id % 1000000000")
def year_similarity(spark, sf_dir):
    return truth_pairs(sql_run(spark, sf_dir)).select(
        "b_row_id", S.year_similarity(C("a.release_year"), C("b.release_year")).alias("year_similarity")
    )


_GA, _GB = E.genre_set("a.genres_list_tmdb"), E.genre_set("b.genres_list_imdb")


@register("genre_similarity", f"SELECT b_row_id, {E.genre_sim(_GA, _GB)} AS genre_similarity FROM clean_a a JOIN clean_b b ON a.a_row_id = b.b_row_id % 1000000000")
def genre_similarity(spark, sf_dir):
    return truth_pairs(sql_run(spark, sf_dir)).select(
        "b_row_id", S.genre_similarity(C("a.genres_list_tmdb"), C("b.genres_list_imdb")).alias("genre_similarity")
    )


_SIGNALS = (
    f"SELECT b_row_id, (CASE WHEN b.title_norm IS NOT NULL THEN 80.0 END)::double AS t, {E.year_sim('a.release_year', 'b.release_year')} AS y, "
    f"{E.runtime_sim('a.runtime_min', 'b.runtime_min')} AS r, {E.genre_sim(_GA, _GB)} AS g "
    f"FROM clean_a a JOIN clean_b b ON a.a_row_id = b.b_row_id % 1000000000"
)


def _signals(spark, sf_dir) -> DataFrame:
    return truth_pairs(sql_run(spark, sf_dir)).select(
        "b_row_id",
        F.when(C("b.title_norm").isNotNull(), 80.0).alias("t"),
        S.year_similarity(C("a.release_year"), C("b.release_year")).alias("y"),
        S.runtime_similarity(C("a.runtime_min"), C("b.runtime_min")).alias("r"),
        S.genre_similarity(C("a.genres_list_tmdb"), C("b.genres_list_imdb")).alias("g"),
    )


@register("composite_linkage_score", f"SELECT b_row_id, {E.score('t', 'y', 'r', 'g')} AS linkage_score FROM signals", signals=_SIGNALS)
def composite_linkage_score(spark, sf_dir):
    return _signals(spark, sf_dir).select(
        "b_row_id", S.composite_linkage_score(C("t"), C("y"), C("r"), C("g")).alias("linkage_score")
    )


@register(
    "classify_match",
    f"SELECT match_status, count(*) AS n FROM (SELECT {E.status(E.score('t', 'y', 'r', 'g'))} AS match_status FROM signals) GROUP BY 1",
    signals=_SIGNALS,
)
def classify_match(spark, sf_dir):
    scored = _signals(spark, sf_dir).select(S.composite_linkage_score(C("t"), C("y"), C("r"), C("g")).alias("s"))
    return scored.groupBy(S.classify_match(C("s")).alias("match_status")).agg(F.count(F.lit(1)).alias("n"))


@register(
    "linkage_input",
    "SELECT 'a' AS side, * REPLACE (array_to_string(genre_set, '|') AS genre_set) FROM link_a UNION ALL "
    "SELECT 'b' AS side, * REPLACE (array_to_string(genre_set, '|') AS genre_set) FROM link_b",
)
def linkage_input(spark, sf_dir):
    a, b = sql_run(spark, sf_dir).links
    return flat(a.select(F.lit("a").alias("side"), "*").unionByName(b.select(F.lit("b").alias("side"), "*")))


@register("match_exact", "SELECT * FROM exact")
def match_exact(spark, sf_dir):
    return link.match_exact(*sql_run(spark, sf_dir).links)


def _rest(run, column: str) -> tuple[DataFrame, DataFrame]:
    """Link rows of both sides not matched by the first layer, or by the first two."""
    a, b = run.links
    layers = ["exact_title_year", "exact_title_year_pm1"]
    found = run.matches.where(C("match_method").isin(layers if column == "all" else layers[:1]))
    return link.without_matched(a, found, "a_row_id"), link.without_matched(b, found, "b_row_id")


@register("match_year_pm1", "SELECT * FROM pm1")
def match_year_pm1(spark, sf_dir):
    return link.match_year_pm1(*_rest(sql_run(spark, sf_dir), "exact"))


@register(
    "block_candidates",
    "SELECT first_letter, release_year, count(DISTINCT a_id) AS rows_a, count(DISTINCT b_id) AS rows_b, count(*) AS n_pairs FROM ("
    "SELECT a.first_letter, a.release_year, a.row_id AS a_id, b.row_id AS b_id FROM rest2_a a JOIN rest2_b b "
    "ON a.first_letter = b.first_letter AND abs(a.release_year - b.release_year) <= 1) GROUP BY 1, 2",
)
def block_candidates(spark, sf_dir):
    return link.block_candidates(*_rest(sql_run(spark, sf_dir), "all"))


_KEY_PAIRS = (
    "SELECT b_row_id, a.title_norm AS a_key, b.title_norm AS b_key FROM clean_a a JOIN clean_b b "
    "ON a.a_row_id = b.b_row_id % 1000000000 WHERE b.title_norm IS NOT NULL"
)


def _key_pairs(spark, sf_dir) -> DataFrame:
    pairs = truth_pairs(sql_run(spark, sf_dir)).where(C("b.title_norm").isNotNull())
    return pairs.select("b_row_id", C("a.title_norm").alias("a_key"), C("b.title_norm").alias("b_key"))


@register("indel_ratio", f"SELECT b_row_id, round({E.ratio('a_key', 'b_key')}, 6) AS ratio FROM key_pairs", key_pairs=_KEY_PAIRS)
def indel_ratio(spark, sf_dir):
    return _key_pairs(spark, sf_dir).select("b_row_id", F.round(indel.indel_ratio(C("a_key"), C("b_key")), 6).alias("ratio"))


_SORTED = [f"array_to_string({E.tokens(k)}, ' ')" for k in ("a_key", "b_key")]


@register("token_sort_ratio", f"SELECT b_row_id, round({E.ratio('ka', 'kb')}, 6) AS ratio FROM (SELECT b_row_id, {_SORTED[0]} AS ka, {_SORTED[1]} AS kb FROM key_pairs)", key_pairs=_KEY_PAIRS)
def token_sort_ratio(spark, sf_dir):
    return _key_pairs(spark, sf_dir).select(
        "b_row_id", F.round(indel.token_sort_ratio(C("a_key"), C("b_key")), 6).alias("ratio")
    )


@register(
    "token_set_ratio",
    f"SELECT b_row_id, round(token_set, 6) AS ratio FROM ({token_set('key_pairs', 'b_row_id')})",
    key_pairs=_KEY_PAIRS,
)
def token_set_ratio(spark, sf_dir):
    return _key_pairs(spark, sf_dir).select(
        "b_row_id", F.round(indel.token_set_ratio(C("a_key"), C("b_key")), 6).alias("ratio")
    )


@register("fuzzy_top_k", "SELECT b_key, a_row_id, round(token_set, 6) AS token_set FROM top_k")
def fuzzy_top_k(spark, sf_dir):
    top = link.fuzzy_top_k(*_rest(sql_run(spark, sf_dir), "all"))
    return top.select("b_key", "a_row_id", F.round("token_set", 6).alias("token_set"))


_MATCH_ROUNDED = (
    "SELECT * REPLACE (round(title_similarity, 6) AS title_similarity, round(linkage_score, 6) AS linkage_score) FROM {}"
)


def _rounded(matches: DataFrame) -> DataFrame:
    return matches.withColumns({c: F.round(c, 6) for c in ("title_similarity", "linkage_score")})


@register("match_fuzzy_blocked", _MATCH_ROUNDED.format("fuzzy"))
def match_fuzzy_blocked(spark, sf_dir):
    return _rounded(link.match_fuzzy_blocked(*_rest(sql_run(spark, sf_dir), "all")))


_SCORED_CANDIDATES = (
    "SELECT a_row_id, b_row_id, greatest(token_set, token_sort, ratio) AS linkage_score FROM candidates"
)


@register(
    "resolve_one_to_one",
    "SELECT a_row_id, b_row_id, round(linkage_score, 6) AS linkage_score FROM ("
    "SELECT *, row_number() OVER (PARTITION BY b_row_id ORDER BY linkage_score DESC, a_row_id) AS rb FROM ("
    "SELECT *, row_number() OVER (PARTITION BY a_row_id ORDER BY linkage_score DESC, b_row_id) AS ra FROM scored"
    ") WHERE ra = 1) WHERE rb = 1",
    scored=_SCORED_CANDIDATES,
)
def resolve_one_to_one(spark, sf_dir):
    pairs = link.fuzzy_candidates(*_rest(sql_run(spark, sf_dir), "all")).select(
        "a_row_id", "b_row_id", F.greatest("token_set", "token_sort", "ratio").alias("linkage_score")
    )
    return link.resolve_one_to_one(pairs).withColumn("linkage_score", F.round("linkage_score", 6))


@register("linkage_cascade", _MATCH_ROUNDED.format("matches_all"))
def linkage_cascade(spark, sf_dir):
    return _rounded(full_run(spark, sf_dir).matches)


@register("strong_only", "SELECT a_row_id, b_row_id, match_method FROM matches_all WHERE match_status = 'strong_match'")
def strong_only(spark, sf_dir):
    return link.strong_only(full_run(spark, sf_dir).matches).select("a_row_id", "b_row_id", "match_method")


@register(
    "review_sets",
    "SELECT a_row_id, b_row_id, match_status FROM matches_all WHERE match_status IN ('probable_match', 'manual_review')",
)
def review_sets(spark, sf_dir):
    matches = full_run(spark, sf_dir).matches
    both = link.review_set(matches, "probable_match").unionByName(link.review_set(matches, "manual_review"))
    return both.select("a_row_id", "b_row_id", "match_status")


def _histogram_sql(source: str, column: str, bins: int) -> str:
    return (
        f"SELECT i::int AS bin, round(lo + i * (hi - lo) / {bins}, 6) AS bin_start, coalesce(n, 0) AS n FROM "
        f"(SELECT min({column}) AS lo, max({column}) AS hi FROM {source}) e, (SELECT unnest(range({bins})) AS i) r LEFT JOIN ("
        f"SELECT least(floor(({column} - lo) / ((hi - lo) / {bins})), {bins - 1})::int AS b, count(*) AS n FROM {source}, "
        f"(SELECT min({column}) AS lo, max({column}) AS hi FROM {source}) WHERE {column} IS NOT NULL GROUP BY 1) h ON h.b = r.i"
    )


def _bins(df: DataFrame) -> DataFrame:
    return df.withColumn("bin_start", F.round("bin_start", 6))


@register("linkage_score_histogram", _histogram_sql("matches_all", "linkage_score", 30))
def linkage_score_histogram(spark, sf_dir):
    return _bins(link.linkage_score_histogram(sql_run(spark, sf_dir).matches))


# --- golden record -------------------------------------------------------------------------------

_TRUTH_FROM = "FROM clean_a a JOIN clean_b b ON a.a_row_id = b.b_row_id % 1000000000"


def _conflict_query(name: str, a: str, b: str, limit: float) -> None:
    @register(name, f"SELECT b_row_id, coalesce(abs(a.{a} - b.{b}) > {limit}, false) AS conflict {_TRUTH_FROM}")
    def run(spark, sf_dir):
        return truth_pairs(sql_run(spark, sf_dir)).select(
            "b_row_id", S.gap_conflict(C(f"a.{a}"), C(f"b.{b}"), limit).alias("conflict")
        )


_conflict_query("conflict_runtime", "runtime_min", "runtime_min", 10)
_conflict_query("conflict_rating", "vote_average_tmdb", "rating_imdb", 2.0)
_conflict_query("conflict_year", "release_year", "release_year", 1)


@register("conflict_genre", f"SELECT b_row_id, {CONFLICT_GENRE} AS conflict {_TRUTH_FROM}")
def conflict_genre(spark, sf_dir):
    return truth_pairs(sql_run(spark, sf_dir)).select(
        "b_row_id", S.conflict_genre(C("a.genres_list_tmdb"), C("b.genres_list_imdb")).alias("conflict")
    )


@register(
    "union_genres",
    f"SELECT b_row_id, array_to_string({union_genres('a.genres_list_tmdb', 'b.genres_list_imdb')}, '|') AS genres {_TRUTH_FROM}",
)
def union_genres_query(spark, sf_dir):
    return truth_pairs(sql_run(spark, sf_dir)).select(
        "b_row_id",
        F.array_join(golden.union_genres(C("a.genres_list_tmdb"), C("b.genres_list_imdb")), "|").alias("genres"),
    )


_RATING_ARGS = ("a.vote_average_tmdb", "a.vote_count_tmdb", "b.rating_imdb", "b.user_rating_count_imdb")


@register("weighted_rating", f"SELECT b_row_id, round({weighted_rating(*_RATING_ARGS)}, 6) AS rating {_TRUTH_FROM}")
def weighted_rating_query(spark, sf_dir):
    return truth_pairs(sql_run(spark, sf_dir)).select(
        "b_row_id", F.round(golden.weighted_rating(*[C(c) for c in _RATING_ARGS]), 6).alias("rating")
    )


@register(
    "profit_roi",
    "SELECT a_row_id, "
    + ", ".join(f"round({profit(p)}, 6) AS {p}" for p in ("profit", "roi", "is_profitable"))
    + " FROM clean_a a",
)
def profit_roi(spark, sf_dir):
    derived = sql_run(spark, sf_dir).clean_a.select(
        "a_row_id", golden.profit_roi(C("budget_usd"), C("revenue_usd")).alias("p")
    )
    return derived.select("a_row_id", *[F.round(f"p.{p}", 6).alias(p) for p in ("profit", "roi", "is_profitable")])


@register(
    "survivorship_coalesce",
    f"SELECT b_row_id, CASE WHEN {E.missing_text('b.title_display_imdb')} THEN a.title_display_tmdb ELSE b.title_display_imdb END AS title, "
    f"coalesce(a.runtime_min, b.runtime_min) AS runtime_min, coalesce(a.release_year, b.release_year) AS release_year {_TRUTH_FROM}",
)
def survivorship_coalesce(spark, sf_dir):
    return truth_pairs(sql_run(spark, sf_dir)).select(
        "b_row_id",
        golden.survivor(C("b.title_display_imdb"), C("a.title_display_tmdb"), P.is_missing_text).alias("title"),
        golden.survivor(C("a.runtime_min"), C("b.runtime_min"), lambda c: c.isNull()).alias("runtime_min"),
        golden.survivor(C("a.release_year"), C("b.release_year"), lambda c: c.isNull()).alias("release_year"),
    )


_MASTER_COLUMNS = [
    "movie_master_id", "record_type", "source_row_id", "tmdb_id", "imdb_path", "source_count", "source_trace",
    "title_display", "title_display_tmdb", "title_display_imdb", "title_norm", "release_date", "release_year",
    "release_decade", "release_year_tmdb", "release_year_imdb", "year_conflict", "runtime_min", "runtime_tmdb",
    "runtime_imdb", "runtime_conflict", "budget_usd", "revenue_usd", "budget_observed", "revenue_observed",
    "budget_was_zero", "revenue_was_zero", "profit_usd", "roi", "is_profitable", "vote_average_tmdb",
    "vote_count_tmdb", "popularity_tmdb", "rating_imdb", "user_rating_count_imdb", "rating_normalized",
    "rating_conflict", "genres_list", "genres_canonical", "genre_conflict", "original_language", "origin_country",
    "director", "writer", "cast", "overview", "keywords", "production_companies", "adult", "linkage_score",
    "linkage_status", "match_method", "title_missing", "year_out_of_range", "runtime_out_of_range",
    "rating_missing", "genres_missing", "completeness_score", "validity_score", "consistency_score",
    "uniqueness_score", "traceability_score", "data_quality_score",
]
_MASTER_SQL = (
    "SELECT "
    + ", ".join(
        {
            "release_date": "cast(release_date AS varchar) AS release_date",
            "genres_list": "array_to_string(genres_list, '|') AS genres_list",
            "linkage_score": "round(linkage_score, 6) AS linkage_score",
            "rating_normalized": "round(rating_normalized, 6) AS rating_normalized",
            "roi": "round(roi, 6) AS roi",
        }.get(c, f'"{c}"')
        for c in _MASTER_COLUMNS
    )
    + " FROM master_plain"
)


def _master_rows(df: DataFrame) -> DataFrame:
    return flat(df.select(*_MASTER_COLUMNS)).withColumns(
        {c: F.round(c, 6) for c in ("linkage_score", "rating_normalized", "roi")}
    )


@register("golden_record", _MASTER_SQL)
def golden_record(spark, sf_dir):
    run = sql_run(spark, sf_dir)
    return _master_rows(golden.golden_record(run.clean_a, run.clean_b, run.strong, StageStore(spark).save))


@register("build_merged", _MASTER_SQL + " WHERE record_type = 'merged'")
def build_merged(spark, sf_dir):
    return _master_rows(reports.subset_merged(sql_run(spark, sf_dir).master_plain))


_A_ONLY = ["source_row_id", "tmdb_id", "title_display", "runtime_min", "budget_usd", "revenue_usd", "genres_canonical", "rating_missing"]


@register("build_a_only", f"SELECT {', '.join(_A_ONLY)} FROM master_plain WHERE record_type = 'tmdb_only'")
def build_a_only(spark, sf_dir):
    run = sql_run(spark, sf_dir)
    built = golden.build_from_a(run.clean_a, run.clean_b, run.strong)
    return built.where(C("record_type") == "tmdb_only").select(*_A_ONLY)


_B_ONLY = ["source_row_id", "imdb_path", "title_display", "runtime_min", "rating_imdb", "genres_canonical", "overview", "rating_missing"]


@register("build_b_only", f"SELECT {', '.join(_B_ONLY)} FROM master_plain WHERE record_type = 'imdb_only'")
def build_b_only(spark, sf_dir):
    run = sql_run(spark, sf_dir)
    return golden.build_b_only(run.clean_b, run.strong).select(*_B_ONLY)


@register("source_trace", "SELECT record_type, source_count, source_trace, count(*) AS n FROM master_plain GROUP BY 1, 2, 3")
def source_trace(spark, sf_dir):
    return sql_run(spark, sf_dir).master_plain.groupBy("record_type", "source_count", "source_trace").agg(
        F.count(F.lit(1)).alias("n")
    )


@register(
    "assign_master_id",
    "SELECT printf('M_%07d', row_number() OVER (ORDER BY CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 2 ELSE 3 END, o_orderkey)) AS id, "
    "o_orderkey, o_orderstatus FROM orders",
)
def assign_master_id(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return golden.assign_master_id(rows, ["O", "P", "F"], "o_orderstatus", "o_orderkey", "id", StageStore(spark).save)


_SCORES = [f"{d}_score" for d in ("completeness", "validity", "consistency", "uniqueness", "traceability", "data_quality")]


@register("quality_scores", f"SELECT movie_master_id, {', '.join(_SCORES)} FROM master_plain")
def quality_scores(spark, sf_dir):
    rows = sql_run(spark, sf_dir).master_plain.drop(*_SCORES)
    return quality.quality_scores(rows).select("movie_master_id", *_SCORES)


# --- outliers ------------------------------------------------------------------------------------


@register(
    "exact_quantiles",
    "SELECT event_type, round(quantile_cont(value, 0.01), 6) AS p01, round(quantile_cont(value, 0.5), 6) AS p50, "
    "round(quantile_cont(value, 0.97), 6) AS p97, count(value) AS n FROM events GROUP BY 1",
)
def exact_quantiles_query(spark, sf_dir):
    levels = {"p01": 0.01, "p50": 0.5, "p97": 0.97}
    found = exact_quantiles(table(spark, sf_dir, "events"), "value", levels, ["event_type"])
    return found.select("event_type", *[F.round(p, 6).alias(p) for p in levels], C("__n").alias("n"))


def _bounds_sql(pairs: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(q1, 6) AS q1, round(q3, 6) AS q3, round(q1 - 1.5 * (q3 - q1), 6) AS lower_bound, "
        f"round(q3 + 1.5 * (q3 - q1), 6) AS upper_bound FROM (SELECT quantile_cont({c}::double, 0.25) AS q1, "
        f"quantile_cont({c}::double, 0.75) AS q3 FROM {t})"
        for c, t in pairs
    )


_BOUND_COLUMNS = ["q1", "q3", "lower_bound", "upper_bound"]


def _rounded_bounds(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in _BOUND_COLUMNS})


@register("iqr_bounds", _bounds_sql([("value", "events"), ("n_chars", "documents"), *[(c, "master_plain") for c in IQR_COLUMNS]]))
def iqr_bounds(spark, sf_dir):
    found = [
        outliers.iqr_bounds(table(spark, sf_dir, "events"), ["value"]),
        outliers.iqr_bounds(table(spark, sf_dir, "documents"), ["n_chars"]),
        sql_run(spark, sf_dir).bounds,
    ]
    return _rounded_bounds(found[0].unionByName(found[1]).unionByName(found[2]))


@register(
    "iqr_flags",
    "SELECT event_id, coalesce(value < (SELECT quantile_cont(value, 0.25) - 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) FROM events) "
    "OR value > (SELECT quantile_cont(value, 0.75) + 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) FROM events), false) AS value_outlier_iqr FROM events",
)
def iqr_flags(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "value")
    return outliers.iqr_flags(events, ["value"], outliers.iqr_bounds(events, ["value"])).select("event_id", "value_outlier_iqr")


@register(
    "iqr_summary",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", (SELECT round(lower_bound, 6) FROM bounds WHERE \"column\" = '{c}') AS lower_bound, "
        f"(SELECT round(upper_bound, 6) FROM bounds WHERE \"column\" = '{c}') AS upper_bound, count_if({c}_outlier_iqr) AS n_outliers, "
        f"round(count_if({c}_outlier_iqr)::double / count(*) * 100, 4) AS pct_outliers FROM master"
        for c in IQR_COLUMNS
    ),
)
def iqr_summary(spark, sf_dir):
    run = sql_run(spark, sf_dir)
    summary = outliers.iqr_summary(run.master, run.bounds, outliers.IQR_COLUMNS)
    return summary.withColumns({c: F.round(c, 6) for c in ("lower_bound", "upper_bound")})


@register("isolation_forest")
def isolation_forest(spark, sf_dir):
    return full_run(spark, sf_dir).master.groupBy("record_type", "multivariate_outlier_iso").agg(
        F.count(F.lit(1)).alias("n")
    )


_LINE = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@register("isolation_forest_lineitem")
def isolation_forest_lineitem(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *_LINE).alias("row_key"), *_LINE
    )
    store = StageStore(spark)
    flagged = outliers.isolation_forest(rows, "row_key", store.save, _LINE, ("l_extendedprice",))
    return flagged.groupBy("multivariate_outlier_iso").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("l_extendedprice"), 2).alias("mean_price")
    )


@register("any_outlier_flag", "SELECT movie_master_id, any_outlier_flag FROM master")
def any_outlier_flag(spark, sf_dir):
    rows = sql_run(spark, sf_dir).master.drop("any_outlier_flag")
    return outliers.any_outlier_flag(rows).select("movie_master_id", "any_outlier_flag")


@register(
    "outliers_by_type",
    "SELECT record_type, " + ", ".join(f"count_if({c}_outlier_iqr) AS {c}_outlier_iqr" for c in IQR_COLUMNS) + " FROM master GROUP BY 1",
)
def outliers_by_type(spark, sf_dir):
    return outliers.outliers_by_type(sql_run(spark, sf_dir).master)


# --- reports on the master table -----------------------------------------------------------------

_MASTER_TYPES = {
    "movie_master_id": "string", "record_type": "string", "source_count": "int", "release_year": "int",
    "runtime_min": "double", "budget_usd": "double", "revenue_usd": "double", "genres_canonical": "string",
    "director": "string", "overview": "string", "runtime_conflict": "boolean", "linkage_status": "string",
    "data_quality_score": "double",
}


@register("profile_after", _profile_sql("movie_master", "master", _MASTER_TYPES))
def profile_after(spark, sf_dir):
    return profile.profile_columns(sql_run(spark, sf_dir).master.select(*_MASTER_TYPES), "movie_master")


@register(
    "record_type_summary",
    "SELECT record_type, count(*) AS count, round(count(*)::double / (SELECT count(*) FROM master) * 100, 4) AS pct FROM master GROUP BY 1",
)
def record_type_summary(spark, sf_dir):
    return audit.record_type_summary(sql_run(spark, sf_dir).master)


_N = {k: f"count_if(record_type = '{k}')" for k in ("merged", "tmdb_only", "imdb_only")}


@register(
    "coverage_summary",
    _metrics_sql(
        {
            "merged_records": _N["merged"], "tmdb_only_records": _N["tmdb_only"], "imdb_only_records": _N["imdb_only"],
            "movie_master_total": "count(*)",
            "tmdb_fusion_rate_pct": f"round({_N['merged']}::double / ({_N['merged']} + {_N['tmdb_only']}) * 100, 4)",
            "imdb_fusion_rate_pct": f"round({_N['merged']}::double / ({_N['merged']} + {_N['imdb_only']}) * 100, 4)",
        },
        "master",
    ),
)
def coverage_summary(spark, sf_dir):
    return audit.coverage_summary(sql_run(spark, sf_dir).master)


def _null_cells(columns) -> str:
    return " + ".join(f'count_if("{c}" IS NULL)' for c in columns)


_RAW_A = ["row_id", *_CAT_A, "vote_count"]


@register(
    "quality_before_after",
    _metrics_sql(
        {
            "rows_before": "max((SELECT count(*) FROM cat_a) + (SELECT count(*) FROM cat_b))",
            "rows_after": "count(*)",
            "null_cells_before": f"max((SELECT {_null_cells(_RAW_A)} FROM cat_a) + (SELECT {_null_cells(_CSV_COLUMNS)} FROM cat_b))",
            "null_cells_after": _null_cells(_MASTER_COLUMNS),
            "dqs_mean_after": "(2 * sum(round(data_quality_score * 10000)::bigint) + count(data_quality_score)) // (2 * count(data_quality_score)) / 10000.0",
            "dqs_median_after": "round(quantile_cont(data_quality_score, 0.5), 4)",
            "merged_pct_after": "round(avg((record_type = 'merged')::int) * 100, 4)",
        },
        "master_plain",
    ),
)
def quality_before_after(spark, sf_dir):
    run = sql_run(spark, sf_dir)
    return audit.quality_before_after(run.raw_a, run.raw_b, run.master_plain)


_FLAGLESS = "SELECT *, NULL AS multivariate_outlier_iso FROM master"
_CHECK_NAMES = (
    "two_sources_loaded", "dedup_a", "dedup_b", "title_norm_present", "linkage_ran", "linkage_score_column",
    "linkage_status_column", "match_method_column", "golden_record_created", "record_type_three_values",
    "row_identity", "source_trace_column", "source_count_column", "data_quality_score_present",
    "data_quality_score_range", "completeness_present", "validity_present", "consistency_present",
    "outliers_flagged_not_removed", "multivariate_flag_present", "budget_not_imputed", "revenue_not_imputed",
    "genres_canonical_present", "rating_normalized_present", "only_strong_fused", "source_count_complete",
    "titles_not_imputed", "conflict_flags_present",
)


def _audit_sql() -> str:
    na, nb = "(SELECT count(*) FROM clean_a)", "(SELECT count(*) FROM clean_b)"
    nm, n = "(SELECT count(*) FROM strong)", "(SELECT count(*) FROM master)"
    rules = {
        "two_sources_loaded": (f"{na} > 0 AND {nb} > 0", f"concat('a=', {na}, ', b=', {nb})"),
        "dedup_a": ("(SELECT count(*) - count(DISTINCT tmdb_id) FROM clean_a) = 0", "'duplicates=0'"),
        "dedup_b": (
            "(SELECT count(*) FROM clean_b) = (SELECT count(*) FROM (SELECT DISTINCT title_norm, release_year FROM clean_b))",
            "'duplicates=0'",
        ),
        "linkage_ran": (f"{nm} > 0", f"concat('strong=', {nm})"),
        "golden_record_created": (f"{n} > 0", f"concat('rows=', {n})"),
        "record_type_three_values": ("(SELECT count(DISTINCT record_type) FROM master) = 3", "''"),
        "row_identity": (f"{n} = {na} + {nb} - {nm}", f"concat({n}, ' = ', {na}, ' + ', {nb}, ' - ', {nm})"),
        "data_quality_score_range": ("(SELECT bool_and(data_quality_score BETWEEN 0 AND 1) FROM master)", "''"),
        "multivariate_flag_present": ("false", "''"),
        "budget_not_imputed": ("(SELECT bool_and((budget_usd IS NOT NULL) = budget_observed) FROM master)", "''"),
        "revenue_not_imputed": ("(SELECT bool_and((revenue_usd IS NOT NULL) = revenue_observed) FROM master)", "''"),
        "titles_not_imputed": (
            "(SELECT bool_and(title_display IN (title_display_tmdb, title_display_imdb)) FROM master WHERE record_type = 'merged')",
            "''",
        ),
    }
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"check\", CASE WHEN {rules.get(c, ('true', chr(39) * 2))[0]} THEN 'PASS' ELSE 'FAIL' END AS status, "
        f"{rules.get(c, ('true', chr(39) * 2))[1]} AS detail"
        for c in _CHECK_NAMES
    )


@register("audit_checks", _audit_sql())
def audit_checks(spark, sf_dir):
    run = sql_run(spark, sf_dir)
    return audit.audit_checks(run.clean_a, run.clean_b, run.strong, run.master)


@register(
    "dqs_boxplot_stats",
    "SELECT record_type, "
    + ", ".join(
        f"round(quantile_cont(data_quality_score, {p}), 6) AS dqs_{n}"
        for n, p in (("min", 0.0), ("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("max", 1.0))
    )
    + ", count(*) AS n FROM master GROUP BY 1",
)
def dqs_boxplot_stats(spark, sf_dir):
    df = audit.dqs_boxplot_stats(sql_run(spark, sf_dir).master)
    return df.withColumns({f"dqs_{n}": F.round(f"dqs_{n}", 6) for n in ("min", "q1", "median", "q3", "max")})


_DIMS = ["completeness_score", "validity_score", "consistency_score", "traceability_score", "data_quality_score"]


@register("quality_dims_by_type", "SELECT record_type, " + ", ".join(f"floor((2 * sum(round({d} * 10000)::BIGINT)::BIGINT + count({d})) / (2 * count({d}))) / 10000 AS {d}" for d in _DIMS) + " FROM master GROUP BY 1")
def quality_dims_by_type(spark, sf_dir):
    return audit.quality_dims_by_type(sql_run(spark, sf_dir).master)


def _clipped(column: str, source: str) -> str:
    return (
        f"SELECT greatest(least({column}, (SELECT quantile_cont({column}, 0.99) FROM {source})), "
        f"(SELECT quantile_cont({column}, 0.01) FROM {source})) AS v FROM {source} WHERE {column} IS NOT NULL"
    )


@register("roi_winsor_histogram", _histogram_sql("clipped", "v", 50), clipped=_clipped("roi", "master"))
def roi_winsor_histogram(spark, sf_dir):
    return _bins(audit.winsor_histogram(sql_run(spark, sf_dir).master, "roi"))


@register("winsor_histogram_events", _histogram_sql("clipped", "v", 50), clipped=_clipped("value", "events"))
def winsor_histogram_events(spark, sf_dir):
    return _bins(audit.winsor_histogram(table(spark, sf_dir, "events"), "value"))


@register(
    "log_scatter_points",
    "SELECT movie_master_id, round(ln(1 + budget_usd), 6) AS log_budget, round(ln(1 + revenue_usd), 6) AS log_revenue "
    "FROM master WHERE budget_usd IS NOT NULL AND revenue_usd IS NOT NULL",
)
def log_scatter_points(spark, sf_dir):
    return audit.log_scatter_points(sql_run(spark, sf_dir).master).withColumns(
        {c: F.round(c, 6) for c in ("log_budget", "log_revenue")}
    )


# --- fixed reports -------------------------------------------------------------------------------

_A, _B, _M = (
    "record_type IN ('merged', 'tmdb_only')", "record_type IN ('merged', 'imdb_only')", "record_type = 'merged'",
)
_KNOWN = "director IS NOT NULL AND trim(director) NOT IN ('See company contact information', 'nan', '')"


def _rows(columns: str) -> str:
    out = []
    for c in columns.split():
        out.append(f"round({c}, 6) AS {c}" if c in ("roi", "rating_normalized", "linkage_score", "rating_diff", "commercial_potential_score") else c)
    return "movie_master_id, " + ", ".join(out)


def _report(name: str, sql: str, rounded: tuple[str, ...] = (), run_of=sql_run, **arguments) -> None:
    fn = reports.REPORTS.get(name) or getattr(reports, name)

    @register(name, sql)
    def run(spark, sf_dir):
        df = fn(run_of(spark, sf_dir).master, **arguments)
        return df.withColumns({c: F.round(c, 6) for c in rounded}) if rounded else df


_report(
    "a_q1_top_revenue",
    f"SELECT {_rows('title_display release_year budget_usd revenue_usd profit_usd roi rating_normalized popularity_tmdb record_type')} "
    f"FROM master WHERE {_A} AND revenue_usd IS NOT NULL ORDER BY revenue_usd DESC, movie_master_id LIMIT 10",
    ("roi", "rating_normalized"),
)
_Q2 = {
    "budget_missing": "budget_usd IS NULL", "revenue_missing": "revenue_usd IS NULL", "budget_was_zero": "budget_was_zero",
    "revenue_was_zero": "revenue_was_zero", "budget_usd_outlier_iqr": "budget_usd_outlier_iqr",
    "revenue_usd_outlier_iqr": "revenue_usd_outlier_iqr", "roi_outlier_iqr": "roi_outlier_iqr",
}
_report(
    "a_q2_financial_quality",
    " UNION ALL ".join(
        f"SELECT '{n}' AS metric, count_if({e}) AS count, round(count_if({e})::double / count(*) * 100, 4) AS pct FROM master WHERE {_A}"
        for n, e in _Q2.items()
    ),
)
_report(
    "a_q3_genre_frequency",
    f"SELECT * FROM (SELECT genre, count(*) AS count FROM (SELECT unnest(genres_list) AS genre FROM master WHERE {_A}) "
    "GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15) WHERE genre <> 'Unknown'",
)
_report(
    "a_q4_popularity_by_decade",
    f"SELECT release_decade, round(avg(popularity_tmdb), 4) AS popularity_mean, round(quantile_cont(popularity_tmdb, 0.5), 4) AS popularity_median, "
    f"count(popularity_tmdb) AS n_movies FROM master WHERE {_A} AND popularity_tmdb IS NOT NULL AND release_decade IS NOT NULL GROUP BY 1",
)
_FLAGS = "budget_usd_outlier_iqr::int + revenue_usd_outlier_iqr::int + roi_outlier_iqr::int"
_report(
    "a_q5_top_outliers",
    f"SELECT {_rows('title_display release_year budget_usd revenue_usd roi rating_normalized')}, {_FLAGS} AS n_flags FROM master "
    f"WHERE {_A} AND revenue_usd IS NOT NULL ORDER BY {_FLAGS} DESC, revenue_usd DESC, movie_master_id LIMIT 25",
    ("roi", "rating_normalized"),
)
_report(
    "b_q1_top_rating",
    f"SELECT {_rows('title_display release_year rating_imdb user_rating_count_imdb director record_type')} FROM master "
    f"WHERE {_B} AND rating_imdb IS NOT NULL ORDER BY rating_imdb DESC, movie_master_id LIMIT 10",
)
_report(
    "b_q2_top_directors",
    f"SELECT director, count(*) AS n_movies FROM master WHERE {_B} AND {_KNOWN} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15",
)


def _by_genre(value: str, where: str, mean: str, median: str, n: int) -> str:
    return (
        f"SELECT genre, round(avg({value}), 2) AS {mean}, round(quantile_cont({value}, 0.5), 2) AS {median}, count({value}) AS n_movies "
        f"FROM (SELECT unnest(genres_list) AS genre, {value} FROM master WHERE {where} AND {value} IS NOT NULL) "
        f"WHERE genre <> 'Unknown' GROUP BY 1 HAVING count({value}) >= {n}"
    )


_report("b_q3_runtime_by_genre", _by_genre("runtime_min", _B, "runtime_mean", "runtime_median", 20))
_report(
    "b_q4_missing_fields",
    " UNION ALL ".join(
        f"SELECT '{f}' AS field, count_if({e}) AS n_null, round(count_if({e})::double / count(*) * 100, 4) AS pct_null FROM master WHERE {_B}"
        for f, e in [(f, f"coalesce(trim(\"{f}\"), '') = ''") for f in ("director", "cast", "overview", "keywords")]
        + [(f, f"{f} IS NULL") for f in ("rating_imdb", "runtime_min")]
    ),
)
_report(
    "b_q5_rating_by_decade",
    f"SELECT release_decade, round(avg(rating_imdb), 2) AS rating_mean, round(quantile_cont(rating_imdb, 0.5), 6) AS rating_median, count(rating_imdb) AS n_movies "
    f"FROM master WHERE {_B} AND rating_imdb IS NOT NULL AND release_decade IS NOT NULL GROUP BY 1",
    ("rating_median",),
)
_report(
    "m_q1_top_linkage",
    f"SELECT {_rows('title_display release_year linkage_score match_method vote_average_tmdb rating_imdb rating_normalized')} FROM master "
    f"WHERE {_M} ORDER BY master.linkage_score DESC, movie_master_id LIMIT 20",
    ("linkage_score", "rating_normalized"),
)
_DIFFERENT = "lower(trim(title_display_tmdb)) <> lower(trim(title_display_imdb))"
_report(
    "m_q2_title_differences",
    f"SELECT {_rows('title_display_tmdb title_display_imdb release_year linkage_score match_method')} FROM master "
    f"WHERE {_M} AND {_DIFFERENT} ORDER BY movie_master_id LIMIT 30",
    ("linkage_score",),
)
_report("m_q2_by_method", f"SELECT match_method, count(*) AS count FROM master WHERE {_M} AND {_DIFFERENT} GROUP BY 1")
_report(
    "m_q3_rating_disagreement",
    f"SELECT {_rows('title_display release_year vote_average_tmdb vote_count_tmdb rating_imdb user_rating_count_imdb rating_diff')} "
    f"FROM (SELECT *, abs(vote_average_tmdb - rating_imdb) AS rating_diff FROM master WHERE {_M}) WHERE rating_diff IS NOT NULL "
    "ORDER BY abs(vote_average_tmdb - rating_imdb) DESC, movie_master_id LIMIT 25",
    ("rating_diff",),
)
_report(
    "m_q4_runtime_conflicts",
    f"SELECT {_rows('title_display release_year runtime_tmdb runtime_imdb runtime_diff')} "
    f"FROM (SELECT *, abs(runtime_tmdb - runtime_imdb) AS runtime_diff FROM master WHERE {_M}) WHERE runtime_diff IS NOT NULL "
    "ORDER BY runtime_diff DESC, movie_master_id LIMIT 25",
)
_report(
    "m_q5_high_rating_low_revenue",
    f"SELECT {_rows('title_display release_year rating_imdb revenue_usd budget_usd roi director')} FROM master "
    f"WHERE {_M} AND rating_imdb >= 8.4 AND revenue_usd < 50000000 ORDER BY rating_imdb DESC, movie_master_id LIMIT 25",
    ("roi",),
    max_revenue=50_000_000,
)
_report(
    "m_q6_high_revenue_low_rating",
    f"SELECT {_rows('title_display release_year revenue_usd rating_imdb vote_average_tmdb roi')} FROM master "
    f"WHERE {_M} AND rating_imdb < 5.5 AND revenue_usd > 200000000 ORDER BY revenue_usd DESC, movie_master_id LIMIT 25",
    ("roi",),
)
_report(
    "m_q7_director_revenue",
    f"SELECT director, count(revenue_usd) AS n_movies, round(avg(revenue_usd), 0) AS revenue_mean, sum(revenue_usd) AS revenue_total, "
    f"round(avg(roi), 2) AS roi_mean, round(avg(rating_imdb), 2) AS rating_mean FROM master WHERE {_M} AND {_KNOWN} AND revenue_usd IS NOT NULL "
    "GROUP BY 1 HAVING count(revenue_usd) >= 3 ORDER BY revenue_mean DESC, director LIMIT 20",
)
_report("m_q8_genre_roi", _by_genre("roi", _M, "roi_mean", "roi_median", 20))
_report(
    "m_q9_decade_profitability",
    f"SELECT release_decade, round(avg(is_profitable) * 100, 2) AS profitable_pct, count(is_profitable) AS n_movies FROM master "
    f"WHERE {_M} AND is_profitable IS NOT NULL AND release_decade IS NOT NULL GROUP BY 1",
)
_CALM = " AND ".join(f"NOT coalesce({c}_conflict, false)" for c in ("runtime", "rating", "year", "genre"))
_report(
    "m_q10_high_potential",
    f"SELECT {_rows('title_display release_year revenue_usd rating_imdb rating_normalized commercial_potential_score')} FROM ("
    f"SELECT *, ln(1 + revenue_usd) * rating_imdb / 10.0 AS commercial_potential_score FROM master WHERE {_M} AND {_CALM} "
    "AND revenue_usd IS NOT NULL AND rating_imdb >= 7.5) t ORDER BY t.commercial_potential_score DESC, movie_master_id LIMIT 25",
    ("rating_normalized", "commercial_potential_score"),
)


@register("a_q2_with_isolation")
def a_q2_with_isolation(spark, sf_dir):
    return reports.a_q2_financial_quality(full_run(spark, sf_dir).master)


@register("a_q5_with_isolation")
def a_q5_with_isolation(spark, sf_dir):
    return reports.a_q5_top_outliers(full_run(spark, sf_dir).master)


# --- models and recommender ----------------------------------------------------------------------

_PROFIT = list(models.PROFIT_FEATURES)


@register(
    "prepare_features",
    "SELECT movie_master_id, is_profitable AS target, "
    + ", ".join(
        f"round(coalesce({c}, (SELECT quantile_cont({c}::double, 0.5) FROM master WHERE is_profitable IS NOT NULL)), 6)::double AS {c}"
        for c in _PROFIT
    )
    + f" FROM master WHERE is_profitable IS NOT NULL AND coalesce({', '.join(_PROFIT)}) IS NOT NULL",
)
def prepare_features(spark, sf_dir):
    df = models.prepare_features(sql_run(spark, sf_dir).master, "movie_master_id", "is_profitable", _PROFIT)
    return df.withColumns({c: F.round(c, 6) for c in _PROFIT})


@register("train_test_split")
def train_test_split(spark, sf_dir):
    rows = sql_run(spark, sf_dir).master.where(C("is_profitable").isNotNull()).select("movie_master_id", "is_profitable")
    split = models.train_test_split(rows, "movie_master_id", stratify="is_profitable")
    return split.groupBy("is_profitable", "is_test").agg(F.count(F.lit(1)).alias("n"))


@register("profitability_models")
def profitability_models(spark, sf_dir):
    run = full_run(spark, sf_dir)
    return models.profitability_models(run.master, "movie_master_id", run.stage)


@register("revenue_models")
def revenue_models(spark, sf_dir):
    run = full_run(spark, sf_dir)
    return models.revenue_models(models.revenue_input(run.master), "movie_master_id", run.stage)


@register(
    "content_text",
    "SELECT movie_master_id, concat_ws(' ', array_to_string(genres_list, ' '), "
    "CASE WHEN trim(keywords) NOT IN ('', 'nan') THEN trim(keywords) END, "
    "CASE WHEN trim(overview) NOT IN ('', 'nan') THEN trim(overview) END) AS content_text "
    "FROM master WHERE title_display IS NOT NULL",
)
def content_text(spark, sf_dir):
    return recommend.content_text(sql_run(spark, sf_dir).master)


def _tfidf(source: str, key: str, text: str) -> dict[str, str]:
    return {
        "words": f"SELECT {key} AS key, regexp_extract_all(lower({text}), '{E.TOKEN}') AS w FROM {source}",
        "terms": "SELECT key, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: concat_ws(' ', w[i], w[i + 1])))) AS term FROM words",
        "counts": "SELECT key, term, count(*) AS tf FROM terms GROUP BY 1, 2",
        "vocab": "SELECT term, count(*) AS df FROM counts GROUP BY 1 HAVING count(*) >= 2",
        "weighted": f"SELECT key, term, tf * (ln((1 + (SELECT count(*) FROM {source}))::double / (1 + df)) + 1) AS w FROM counts JOIN vocab USING (term)",
        "features": "SELECT key, term, w / sqrt(sum(w * w) OVER (PARTITION BY key)) AS weight FROM weighted",
    }


@register("tfidf_features", "SELECT key, term, round(weight, 6) AS weight FROM features", **_tfidf("documents", "doc_id", "text"))
def tfidf_features(spark, sf_dir):
    features = recommend.tfidf_features(table(spark, sf_dir, "documents"), "doc_id", "text")
    return features.withColumn("weight", F.round("weight", 6))


_CONTENT = SQL["content_text"].rsplit("\nSELECT movie_master_id, concat_ws", 1)[1]
_CONTENT = "SELECT movie_master_id, concat_ws" + _CONTENT
_NEAR = (
    "SELECT asked, movie_master_id, title_display, release_year, genres_canonical, round(rating_normalized, 6) AS rating_normalized, "
    "round(similarity, 4) AS similarity_score FROM (SELECT query, key, similarity, row_number() OVER (PARTITION BY query ORDER BY similarity DESC, key) AS rn FROM ("
    "SELECT f.key AS query, g.key AS key, round(sum(f.weight * g.weight), 9) AS similarity FROM features f JOIN hits ON f.key = hits.key "
    "JOIN features g ON f.term = g.term AND f.key <> g.key GROUP BY 1, 2)) n JOIN master m ON m.movie_master_id = n.key "
    "JOIN hits ON hits.key = n.query WHERE rn <= 5"
)


@register(
    "recommend", _NEAR, content=_CONTENT,
    hits="SELECT lower(title_display) AS asked, min(movie_master_id) AS key FROM master WHERE lower(title_display) IN (SELECT lower(title_display) FROM master WHERE substr(movie_master_id, 3)::BIGINT % 100 = 0) GROUP BY 1",
    **_tfidf("content", "movie_master_id", "content_text"),
)
def recommend_query(spark, sf_dir):
    run = sql_run(spark, sf_dir)
    titles = run.master.where(golden.master_sequence(C("movie_master_id")) % 100 == 0).select(F.upper("title_display").alias("title"))
    near = recommend.recommend(run.master, run.features, titles)
    return near.withColumn("rating_normalized", F.round("rating_normalized", 6))


@register(
    "cosine_knn",
    "SELECT query, key, similarity FROM (SELECT q.vec_id AS query, e.vec_id AS key, "
    "round(list_dot_product(e.embedding::double[], q.embedding::double[]) / sqrt(list_dot_product(e.embedding::double[], e.embedding::double[])) "
    "/ sqrt(list_dot_product(q.embedding::double[], q.embedding::double[])), 6) AS similarity, "
    "row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_dot_product(e.embedding::double[], q.embedding::double[]) / sqrt(list_dot_product(e.embedding::double[], e.embedding::double[])) "
    "/ sqrt(list_dot_product(q.embedding::double[], q.embedding::double[])), 9) DESC, e.vec_id) AS rn "
    "FROM embeddings q JOIN embeddings e ON e.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0) WHERE rn <= 10",
)
def cosine_knn(spark, sf_dir):
    near = recommend.cosine_knn(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", _hundredths(spark, sf_dir), 10)
    return near.withColumn("similarity", F.round("similarity", 6))


def _hundredths(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").where(C("vec_id") % 100 == 0).select(C("vec_id").alias("key"))


@register("cosine_knn_approximate")
def cosine_knn_approximate(spark, sf_dir):
    near = recommend.cosine_knn_approximate(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", _hundredths(spark, sf_dir), 10)
    return near.withColumn("similarity", F.round("similarity", 6))


@register(
    "cosine_knn_documents",
    "SELECT query, key, round(similarity, 6) AS similarity FROM (SELECT query, key, similarity, row_number() OVER (PARTITION BY query ORDER BY similarity DESC, key) AS rn FROM ("
    "SELECT f.key AS query, g.key AS key, round(sum(f.weight * g.weight), 9) AS similarity FROM features f "
    "JOIN features g ON f.term = g.term AND f.key <> g.key GROUP BY 1, 2)) WHERE rn <= 10",
    **_tfidf("documents", "doc_id", "text"),
)
def cosine_knn_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    features = recommend.tfidf_features(docs, "doc_id", "text")
    near = recommend.sparse_knn(features, docs.select(C("doc_id").alias("key")), 10, together=True)
    return near.withColumn("similarity", F.round("similarity", 6))


# --- rankings ------------------------------------------------------------------------------------


@register(
    "minmax_scale",
    "SELECT o_orderkey, round((o_totalprice - (SELECT min(o_totalprice) FROM orders)) / (SELECT max(o_totalprice) - min(o_totalprice) FROM orders), 6) AS o_totalprice_scaled FROM orders",
)
def minmax_scale(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    scaled = ranking.minmax_scale(rows, ["o_totalprice"])
    return scaled.select("o_orderkey", F.round("o_totalprice_scaled", 6).alias("o_totalprice_scaled"))


_GENRE_STATS = """
SELECT genre, count(title_display) AS n_movies, avg(is_profitable) AS profitable_pct, avg(revenue_usd) AS revenue_mean,
  quantile_cont(revenue_usd, 0.5) AS revenue_median, avg(popularity_tmdb) AS popularity_mean,
  avg(rating_normalized) AS rating_mean, avg(data_quality_score) AS dqs_mean,
  avg(coalesce(release_year >= 2015, false)::int) AS recent_pct, avg((budget_usd IS NOT NULL)::int) AS budget_coverage,
  avg(any_outlier_flag::int) AS outlier_pct
FROM (SELECT unnest(genres_list) AS genre, * FROM master) WHERE genre <> 'Unknown' GROUP BY 1 HAVING count(title_display) >= 30"""


def _scaled(c: str, source: str) -> str:
    x = f"coalesce({c}, 0)"
    return (
        f"(CASE WHEN (SELECT max({x}) - min({x}) FROM {source}) > 0 THEN ({x} - (SELECT min({x}) FROM {source})) / "
        f"(SELECT max({x}) - min({x}) FROM {source}) ELSE 0.5 END)"
    )


_GENRE_SCORE = " + ".join(f"({w}) * {_scaled(c, 'genre_stats')}" for c, w in ranking.GENRE_WEIGHTS.items())
# compared to ten decimals, where float sums of any order agree; money has fewer to give
_GENRE_ROUND = dict.fromkeys(
    ["profitable_pct", "popularity_mean", "rating_mean", "dqs_mean", "recent_pct", "budget_coverage", "outlier_pct"], 10
) | {"revenue_mean": 4, "revenue_median": 4}
_GENRE_RANKING = (
    "SELECT genre, n_movies, " + ", ".join(f"round({c}, {d}) AS {c}" for c, d in _GENRE_ROUND.items())
    + f", round({_GENRE_SCORE}, 4) AS strategic_investment_score FROM genre_stats"
)


@register("genre_investment_ranking", _GENRE_RANKING, genre_stats=_GENRE_STATS)
def genre_investment_ranking(spark, sf_dir):
    return ranking.genre_investment_ranking(sql_run(spark, sf_dir).master).withColumns(
        {c: F.round(c, d) for c, d in _GENRE_ROUND.items()}
    )


_MARKET_ROWS = (
    f"SELECT *, ln(1 + revenue_usd) AS log_revenue FROM master WHERE {_CALM} AND revenue_usd IS NOT NULL "
    "AND rating_normalized IS NOT NULL AND popularity_tmdb IS NOT NULL"
)
_MARKET_SCORE = "round(" + " + ".join(f"{w} * {_scaled(c, 'market')}" for c, w in ranking.MARKETING_WEIGHTS.items()) + ", 4)"
_MARKETING = (
    f"SELECT {_rows('title_display release_year revenue_usd rating_normalized popularity_tmdb genres_canonical')}, "
    f"{_MARKET_SCORE} AS marketing_priority_score FROM market ORDER BY marketing_priority_score DESC, movie_master_id LIMIT 50"
)


@register("marketing_priority_ranking", _MARKETING, market=_MARKET_ROWS)
def marketing_priority_ranking(spark, sf_dir):
    return ranking.marketing_priority_ranking(sql_run(spark, sf_dir).master).withColumn(
        "rating_normalized", F.round("rating_normalized", 6)
    )


@register(
    "conclusions_facts",
    " UNION ALL ".join(
        f"SELECT 'technical' AS type, '{n}' AS metric, {e} AS value FROM master"
        for n, e in {
            "n_master": "count(*)::varchar", "n_merged": f"({_N['merged']})::varchar",
            "n_tmdb_only": f"({_N['tmdb_only']})::varchar", "n_imdb_only": f"({_N['imdb_only']})::varchar",
            "dqs_mean": "printf('%.4f', avg(data_quality_score))", "n_outliers": "count_if(any_outlier_flag)::varchar",
        }.items()
    )
    + " UNION ALL SELECT 'business', 'best_genre', genre FROM best_genre UNION ALL SELECT 'business', 'best_genre_score', printf('%.4f', strategic_investment_score) FROM best_genre"
    " UNION ALL SELECT 'business', 'best_marketing', title_display FROM best_film UNION ALL SELECT 'business', 'best_marketing_score', printf('%.4f', marketing_priority_score) FROM best_film",
    genre_stats=_GENRE_STATS, market=_MARKET_ROWS,
    best_genre=f"SELECT * FROM ({_GENRE_RANKING}) ORDER BY strategic_investment_score DESC, genre LIMIT 1",
    best_film=f"SELECT * FROM ({_MARKETING}) ORDER BY marketing_priority_score DESC, title_display LIMIT 1",
)
def conclusions_facts(spark, sf_dir):
    master = sql_run(spark, sf_dir).master
    return ranking.conclusions_facts(
        master, ranking.genre_investment_ranking(master), ranking.marketing_priority_ranking(master)
    )


@register("run_stages")
def run_stages_query(spark, sf_dir):
    """The whole run from the raw catalogues on, as rows per report."""
    base = full_run(spark, sf_dir)
    run = type(base)(base.raw_a, base.raw_b, StageStore(spark))
    results = run_stages(run)
    out = None
    for name, df in results.items():
        one = df.agg(F.lit(name).alias("report"), F.count(F.lit(1)).alias("n_rows"))
        out = one if out is None else out.unionByName(one)
    return out
