"""Golden records: survivorship, conflicts, derived money fields, ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from fusework.config import DEFAULTS, UNKNOWN, Settings
from fusework.functions import parse as P, similarity as S
from fusework.functions.lists import join_list
from fusework.operators.quality import quality_scores
from fusework.session import IntegrityError


def survivor(a: Column, b: Column, missing) -> Column:
    """A's value unless missing, else B's."""
    return F.when(~missing(a), a).otherwise(b)


def union_genres(a: Column, b: Column) -> Column:
    none = F.array().cast("array<string>")
    trimmed = F.transform(F.concat(F.coalesce(a, none), F.coalesce(b, none)), F.trim)
    known = F.array_distinct(
        F.filter(trimmed, lambda g: g.isNotNull() & (g != "") & (F.lower(g) != "unknown"))
    )
    return F.when(F.size(known) > 0, known).otherwise(F.array(F.lit(UNKNOWN)))


def weighted_rating(rating_a: Column, votes_a: Column, rating_b: Column, votes_b: Column) -> Column:
    """Vote-weighted mean of the ratings that exist; a rating without a count weighs 1."""

    def weight(votes: Column) -> Column:
        return F.when(votes > 0, votes).otherwise(1.0)

    wa, wb = weight(votes_a), weight(votes_b)
    both = (rating_a * wa + rating_b * wb) / (wa + wb)
    return F.coalesce(both, rating_a, rating_b)


def profit_roi(budget: Column, revenue: Column) -> Column:
    """``struct<profit, roi, is_profitable>``, only where both amounts were observed."""
    known = (budget > 0) & revenue.isNotNull()
    profit = F.when(known, revenue - budget)
    return F.struct(
        profit.alias("profit"),
        (profit / budget).alias("roi"),
        F.when(known, (revenue > budget).cast("double")).alias("is_profitable"),
    )


def _money(side: str) -> list[Column]:
    budget, revenue = F.col(f"{side}.budget_usd"), F.col(f"{side}.revenue_usd")
    derived = profit_roi(budget, revenue)
    return [
        budget.alias("budget_usd"),
        revenue.alias("revenue_usd"),
        F.coalesce(f"{side}.budget_observed", F.lit(False)).alias("budget_observed"),
        F.coalesce(f"{side}.revenue_observed", F.lit(False)).alias("revenue_observed"),
        F.coalesce(f"{side}.budget_was_zero", F.lit(False)).alias("budget_was_zero"),
        F.coalesce(f"{side}.revenue_was_zero", F.lit(False)).alias("revenue_was_zero"),
        derived["profit"].alias("profit_usd"),
        derived["roi"].alias("roi"),
        derived["is_profitable"].alias("is_profitable"),
    ]


def build_from_a(
    clean_a: DataFrame, clean_b: DataFrame, strong: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """Merged and A-only records in one pass over A.

    B is attached to the few matches first; A is then joined once by its own id, which is unique
    and never NULL, so no join sees a hot or empty key.
    """
    sa, sb = settings.source_a, settings.source_b
    matched = (
        strong.select("a_row_id", "b_row_id", "linkage_score", "match_status", "match_method")
        .join(clean_b.select("b_row_id", F.struct(*[c for c in clean_b.columns]).alias("b")), "b_row_id")
        .drop("b_row_id")
    )
    joined = clean_a.select("a_row_id", F.struct(*clean_a.columns).alias("a")).join(matched, "a_row_id", "left")
    merged = F.col("b").isNotNull()

    def only_merged(c: Column) -> Column:
        return F.when(merged, c)

    list_a, list_b = F.col(f"a.genres_list_{sa}"), F.col(f"b.genres_list_{sb}")
    genres = F.when(merged, union_genres(list_a, list_b)).otherwise(
        F.when(F.size(list_a) > 0, list_a).otherwise(F.array(F.lit(UNKNOWN)))
    )
    rating_a, rating_b = F.col(f"a.vote_average_{sa}"), F.col(f"b.rating_{sb}")
    rating = weighted_rating(
        rating_a, F.col(f"a.vote_count_{sa}"), rating_b, F.col(f"b.user_rating_count_{sb}")
    )
    not_null = Column.isNull
    return joined.select(
        F.when(merged, "merged").otherwise(f"{sa}_only").alias("record_type"),
        F.col("a_row_id").alias("source_row_id"),
        F.col(f"a.{sa}_id").alias(f"{sa}_id"),
        F.col(f"b.{sb}_path").alias(f"{sb}_path"),
        F.when(merged, 2).otherwise(1).alias("source_count"),
        F.when(merged, f"{sa}|{sb}").otherwise(sa).alias("source_trace"),
        survivor(
            F.col(f"a.title_display_{sa}"), F.col(f"b.title_display_{sb}"), P.is_missing_text
        ).alias("title_display"),
        only_merged(F.col(f"a.title_display_{sa}")).alias(f"title_display_{sa}"),
        only_merged(F.col(f"b.title_display_{sb}")).alias(f"title_display_{sb}"),
        survivor(F.col("a.title_norm"), F.col("b.title_norm"), P.is_missing_text).alias("title_norm"),
        survivor(F.col("a.release_date"), F.col("b.release_date"), not_null).alias("release_date"),
        survivor(F.col("a.release_year"), F.col("b.release_year"), not_null).alias("release_year"),
        survivor(F.col("a.release_decade"), F.col("b.release_decade"), not_null).alias("release_decade"),
        only_merged(F.col("a.release_year")).alias(f"release_year_{sa}"),
        only_merged(F.col("b.release_year")).alias(f"release_year_{sb}"),
        only_merged(
            S.gap_conflict(F.col("a.release_year"), F.col("b.release_year"), settings.conflict_year)
        ).alias("year_conflict"),
        survivor(F.col("a.runtime_min"), F.col("b.runtime_min"), not_null).alias("runtime_min"),
        only_merged(F.col("a.runtime_min")).alias(f"runtime_{sa}"),
        only_merged(F.col("b.runtime_min")).alias(f"runtime_{sb}"),
        only_merged(
            S.gap_conflict(F.col("a.runtime_min"), F.col("b.runtime_min"), settings.conflict_runtime)
        ).alias("runtime_conflict"),
        *_money("a"),
        rating_a.alias(f"vote_average_{sa}"),
        F.col(f"a.vote_count_{sa}").alias(f"vote_count_{sa}"),
        F.col(f"a.popularity_{sa}").alias(f"popularity_{sa}"),
        rating_b.alias(f"rating_{sb}"),
        F.col(f"b.user_rating_count_{sb}").alias(f"user_rating_count_{sb}"),
        rating.alias("rating_normalized"),
        only_merged(S.gap_conflict(rating_a, rating_b, settings.conflict_rating)).alias("rating_conflict"),
        genres.alias("genres_list"),
        join_list(genres).alias("genres_canonical"),
        only_merged(S.conflict_genre(list_a, list_b)).alias("genre_conflict"),
        F.col("a.original_language_clean").alias("original_language"),
        F.col("a.origin_country_clean").alias("origin_country"),
        F.col("b.director").alias("director"),
        F.col("b.writer").alias("writer"),
        F.col("b.cast").alias("cast"),
        F.col("b.overview").alias("overview"),
        F.col("b.keywords").alias("keywords"),
        F.col("a.production_companies").alias("production_companies"),
        F.col("a.adult").alias("adult"),
        "linkage_score",
        F.coalesce("match_status", F.lit("no_match")).alias("linkage_status"),
        F.coalesce("match_method", F.lit("no_match")).alias("match_method"),
        (~merged & P.safe_bool(F.col("a.title_missing"))).alias("title_missing"),
        (P.safe_bool(F.col("a.year_out_of_range")) | P.safe_bool(F.col("b.year_out_of_range"))).alias(
            "year_out_of_range"
        ),
        P.safe_bool(F.col("a.runtime_out_of_range")).alias("runtime_out_of_range"),
        rating.isNull().alias("rating_missing"),
        (genres == F.array(F.lit(UNKNOWN))).alias("genres_missing"),
    )


def build_b_only(clean_b: DataFrame, strong: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    sb = settings.source_b
    rest = clean_b.join(strong.select("b_row_id"), "b_row_id", "left_anti")
    listed = F.col(f"genres_list_{sb}")
    genres = F.when(F.size(listed) > 0, listed).otherwise(F.array(F.lit(UNKNOWN)))
    return rest.select(
        F.lit(f"{sb}_only").alias("record_type"),
        F.col("b_row_id").alias("source_row_id"),
        f"{sb}_path",
        F.lit(1).alias("source_count"),
        F.lit(sb).alias("source_trace"),
        F.col(f"title_display_{sb}").alias("title_display"),
        "title_norm",
        "release_date",
        "release_year",
        "release_decade",
        "runtime_min",
        F.lit(False).alias("budget_observed"),
        F.lit(False).alias("revenue_observed"),
        F.lit(False).alias("budget_was_zero"),
        F.lit(False).alias("revenue_was_zero"),
        f"rating_{sb}",
        f"user_rating_count_{sb}",
        F.col(f"rating_{sb}").alias("rating_normalized"),
        genres.alias("genres_list"),
        join_list(genres).alias("genres_canonical"),
        "director",
        "writer",
        "cast",
        "overview",
        "keywords",
        F.lit("no_match").alias("linkage_status"),
        F.lit("no_match").alias("match_method"),
        P.safe_bool(F.col("title_missing")).alias("title_missing"),
        P.safe_bool(F.col("year_out_of_range")).alias("year_out_of_range"),
        P.safe_bool(F.col("rating_missing")).alias("rating_missing"),
        (genres == F.array(F.lit(UNKNOWN))).alias("genres_missing"),
    )


SLICE_ROWS = 1_000_000


def assign_master_id(
    df: DataFrame,
    parts: list[str],
    part: str,
    order: str,
    name: str,
    stage: Callable[[DataFrame, str], DataFrame],
    n_rows: int | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``M_0000001`` ... in the order of ``parts``, then of the unique integer ``order``.

    The rows are dealt into ranges of about ``slice_rows`` rows, sorted there and stored by ``stage``; a row's
    number is its place in its range plus the exact sizes of the ranges before. One shuffle, no window, and the number of
    ranges grows with the table. ``n_rows`` saves counting it. A NULL or repeated ``order`` within a part, and a part that is
    not in ``parts``, raise.

    Ids of seven digits sort as text; :func:`master_sequence` gives the number, which orders ids of any length.
    """
    rows = df.count() if n_rows is None else n_rows
    wanted = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // slice_rows))
    place = F.array_position(F.array(*[F.lit(p) for p in parts]), F.col(part)).cast("int")
    placed = df.select(*df.columns, F.when(place > 0, place).alias("__part"))
    placed = placed.repartitionByRange(wanted, "__part", order).sortWithinPartitions("__part", order)
    # the number of the range and the row's place in it
    spot = F.monotonically_increasing_id()
    placed = stage(placed.withColumn("__spot", spot), f"{name}_ranges")
    number = F.shiftright("__spot", 33).cast("int")
    own = placed.select(number.alias("__range"), "__part", F.col(order).alias("__order"))
    sizes = own.groupBy("__range").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("__part", "__order").alias("different")
    ).orderBy("__range").collect()  # one row for each range
    if any(r.n != r.different for r in sizes):
        raise IntegrityError(f"{sum(r.n - r.different for r in sizes)} rows have no or a repeated {order}")
    offsets, before = [], 0
    for r in sizes:
        offsets.append((r["__range"], before))
        before += r.n
    before_of = df.sparkSession.createDataFrame(offsets, "__range int, __before bigint")
    in_range = F.col("__spot").bitwiseAND((1 << 33) - 1)
    numbered = placed.withColumn("__range", number).join(F.broadcast(before_of), "__range")
    return numbered.select(F.format_string("M_%07d", F.col("__before") + in_range + 1).alias(name), *df.columns)


def master_sequence(master_id: Column) -> Column:
    """The number in a master id: the order of the catalogue, also beyond ten million records."""
    return F.substring(master_id, 3, 20).cast("bigint")


def golden_record(
    clean_a: DataFrame,
    clean_b: DataFrame,
    strong: DataFrame,
    stage: Callable[[DataFrame, str], DataFrame],
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """The master table: merged, A-only and B-only records with ids and quality scores.

    ``stage`` writes a table and reads it back. A source id that is NULL or occurs twice raises.
    """
    everything = build_from_a(clean_a, clean_b, strong, settings).unionByName(
        build_b_only(clean_b, strong, settings), allowMissingColumns=True
    )
    types = ["merged", f"{settings.source_a}_only", f"{settings.source_b}_only"]
    # stored tables answer a count from their footers
    most = clean_a.count() + clean_b.count()
    numbered = assign_master_id(everything, types, "record_type", "source_row_id", "movie_master_id", stage, n_rows=most)
    return quality_scores(numbered, settings)


def golden_checks(n_a: int, n_b: int, n_strong: int, settings: Settings = DEFAULTS):
    """(violations, numbers, function) for the write of the master table: ids, and |master| = |A| + |B| - |strong|, type by type."""
    sequence = master_sequence(F.col("movie_master_id"))
    checks = {"records without an id": F.count_if(sequence.isNull()), "records without a type": F.count_if(F.col("record_type").isNull())}
    types = {
        "merged": n_strong, f"{settings.source_a}_only": n_a - n_strong, f"{settings.source_b}_only": n_b - n_strong,
    }
    counts = {f"n {t}": F.count_if(F.col("record_type") == t) for t in types} | {"first": F.min(sequence), "last": F.max(sequence)}

    def verify(seen: dict) -> list[str]:
        wrong = [f"{seen[f'n {t}']} records of type {t} instead of {n}" for t, n in types.items() if seen[f"n {t}"] != n]
        rows = n_a + n_b - n_strong
        if seen["rows"] != rows:
            wrong.append(f"{seen['rows']} records instead of {n_a} + {n_b} - {n_strong}")
        if rows and (seen["first"], seen["last"]) != (1, rows):
            wrong.append(f"ids from {seen['first']} to {seen['last']}")
        return wrong

    return checks, counts, verify
