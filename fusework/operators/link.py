"""Record linkage without a common key: exact, near-year and blocked fuzzy layers.

A layer never sees rows that an earlier layer matched, so the union of the layers is one-to-one as
soon as every layer is.

Rows that a layer cannot tell apart (same title, year, runtime and genres) are represented by the
one with the smallest id before any join. The resolution breaks ties by id, so no other of them
could be part of a result, and a large group of copies costs one row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from fusework.config import DEFAULTS, Settings
from fusework.functions import similarity as S
from fusework.functions.indel import TokenSetBlock, ratios, sort_tokens
from fusework.functions.text import block_key_first_letter, main_title_token
from fusework.operators.dedup import keep_first
from fusework.operators.quantiles import attach

Stage = Callable[[DataFrame, str], DataFrame]

LINK_COLUMNS = [
    "row_id", "ext_id", "title_display", "title_norm", "release_year", "runtime_min", "genre_set",
    "first_letter", "main_token",
]


def linkage_input(clean: DataFrame, row_id: str, ext_id: str, title_display: str, genres: str) -> DataFrame:
    """The narrow projection that linkage works on: rows with a key and a year."""
    return clean.where(F.col("title_norm").isNotNull() & F.col("release_year").isNotNull()).select(
        F.col(row_id).alias("row_id"),
        F.col(ext_id).alias("ext_id"),
        F.col(title_display).alias("title_display"),
        "title_norm",
        "release_year",
        "runtime_min",
        S.genre_set(F.col(genres)).alias("genre_set"),
        block_key_first_letter(F.col("title_norm")).alias("first_letter"),
        main_title_token(F.col("title_norm")).alias("main_token"),
    )


def linkage_inputs(clean_a: DataFrame, clean_b: DataFrame, settings: Settings = DEFAULTS):
    a, b = settings.source_a, settings.source_b
    return (
        linkage_input(clean_a, "a_row_id", f"{a}_id", f"title_display_{a}", f"genres_list_{a}"),
        linkage_input(clean_b, "b_row_id", f"{b}_path", f"title_display_{b}", f"genres_list_{b}"),
    )


def _representatives(side: DataFrame, keys: Sequence[str], prefix: str, rest: Sequence[str]) -> DataFrame:
    """Per key the row with the smallest id; a partial aggregate runs before the shuffle."""
    best = F.min(F.struct("row_id", *rest)).alias("r")
    return side.groupBy(*keys).agg(best).select(
        *keys, *[F.col(f"r.{c}").alias(f"{prefix}_{c}") for c in ["row_id", *rest]]
    )


def _audit(
    pairs: DataFrame, title_sim: Column, method: str, settings: Settings, score: Column | None = None
) -> DataFrame:
    """The scored pairs with all audit columns but the status."""
    year_sim = S.year_similarity(F.col("a_release_year"), F.col("b_release_year"))
    runtime_sim = S.runtime_similarity(F.col("a_runtime_min"), F.col("b_runtime_min"))
    genre_sim = S.genre_set_similarity(F.col("a_genre_set"), F.col("b_genre_set"))
    scored = pairs.select(
        "a_row_id",
        "b_row_id",
        F.col("a_ext_id").alias("a_id"),
        F.col("b_ext_id").alias("b_id"),
        F.col("a_title_display").alias("a_title"),
        F.col("b_title_display").alias("b_title"),
        F.col("a_release_year").alias("a_year"),
        F.col("b_release_year").alias("b_year"),
        F.col("a_runtime_min").alias("a_runtime"),
        F.col("b_runtime_min").alias("b_runtime"),
        title_sim.alias("title_similarity"),
        year_sim.alias("year_similarity"),
        runtime_sim.alias("runtime_similarity"),
        genre_sim.alias("genre_similarity"),
    )
    if score is None:
        score = S.composite_linkage_score(
            F.col("title_similarity"), F.col("year_similarity"),
            F.col("runtime_similarity"), F.col("genre_similarity"), settings,
        )
    return scored.select("*", score.alias("linkage_score"), F.lit(method).alias("match_method"))


def _with_status(matches: DataFrame, settings: Settings) -> DataFrame:
    return matches.withColumn("match_status", S.classify_match(F.col("linkage_score"), settings))


def resolve_one_to_one(matches: DataFrame) -> DataFrame:
    """Best pair per A row, then best pair per B row among the survivors.

    A row whose best pair loses is not paired again.
    """
    by_score = F.col("linkage_score").desc()
    per_a = keep_first(matches, ["a_row_id"], [by_score, F.col("b_row_id").asc()])
    return keep_first(per_a, ["b_row_id"], [by_score, F.col("a_row_id").asc()])


def match_exact(a: DataFrame, b: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Equal title and year.

    Every pair of a key scores 100, so the resolution leaves exactly the smallest id of each side:
    the keys are aggregated first and no group of pairs is ever formed.
    """
    keys = ["title_norm", "release_year"]
    rest = ["ext_id", "title_display", "runtime_min", "genre_set"]
    pairs = _representatives(a, keys, "a", rest).join(_representatives(b, keys, "b", rest), keys)
    pairs = pairs.withColumn("a_release_year", F.col("release_year")).withColumn(
        "b_release_year", F.col("release_year")
    )
    return _with_status(_audit(pairs, F.lit(100.0), "exact_title_year", settings, score=F.lit(100.0)), settings)


def match_year_pm1(a: DataFrame, b: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Equal title, years at most one apart, as a two-key equi-join on the widened year of B."""
    keys = ["title_norm", "release_year", "runtime_min", "genre_set"]
    rest = ["ext_id", "title_display"]
    left = _representatives(a, keys, "a", rest).select(
        "title_norm", "release_year", F.col("release_year").alias("a_release_year"),
        F.col("runtime_min").alias("a_runtime_min"), F.col("genre_set").alias("a_genre_set"),
        "a_row_id", "a_ext_id", "a_title_display",
    )
    right = _representatives(b, keys, "b", rest).select(
        "title_norm", F.explode(_near_years("release_year")).alias("near_year"),
        F.col("release_year").alias("b_release_year"),
        F.col("runtime_min").alias("b_runtime_min"), F.col("genre_set").alias("b_genre_set"),
        "b_row_id", "b_ext_id", "b_title_display",
    ).withColumnRenamed("near_year", "release_year")
    pairs = left.join(right, ["title_norm", "release_year"])
    scored = _audit(pairs, F.lit(100.0), "exact_title_year_pm1", settings)
    return _with_status(resolve_one_to_one(scored), settings)


def _near_years(column: str) -> Column:
    y = F.col(column)
    return F.array(y - 1, y, y + 1)


def block_sizes(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both sides per block (first letter, year), B counted in all three of its years."""
    right = b.select("first_letter", F.explode(_near_years("release_year")).alias("release_year"))
    keys = ["first_letter", "release_year"]
    return (
        a.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_a"))
        .join(right.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_b")), keys)
    )


def block_candidates(a: DataFrame, b: DataFrame) -> DataFrame:
    """Size of every block and the number of comparisons it stands for."""
    return block_sizes(a, b).withColumn("n_pairs", F.col("rows_a") * F.col("rows_b"))


#: Characters, with padding, of the titles that are compared at a time.
BLOCK_CELLS = 1_000_000

_SCORES = (
    "b_key string, b_year int, a_row_id bigint, token_set double, token_sort double, ratio double"
)


def _blocks(titles: list[str]) -> list[tuple[list[int], TokenSetBlock]]:
    """(places of its titles, block) of blocks of titles of similar length; a long title widens no other's block."""
    order = sorted(range(len(titles)), key=lambda i: len(titles[i]))
    out, start = [], 0
    while start < len(order):
        stop = start + 1
        while stop < len(order) and (stop + 1 - start) * len(titles[order[stop]]) <= BLOCK_CELLS:
            stop += 1
        out.append((order[start:stop], TokenSetBlock([titles[i] for i in order[start:stop]])))
        start = stop
    return out


def _score_block(limit: int):
    def best_of(key: str, blocks, owners: list[list[int]], row_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, score) of the best ``limit`` rows, smallest ids first among equals."""
        places, values, floor = [], np.zeros(0), -1.0
        for own, block in blocks:
            rows, scores = block.best(key, limit, floor)
            places += [own[r] for r in rows]
            values = np.concatenate([values, scores])
            if len(values) >= limit:
                floor = np.partition(values, len(values) - limit)[len(values) - limit]
        found = [(r, v) for p, v in zip(places, values) if v >= floor for r in owners[p]]
        rows, values = np.array([r for r, _ in found], np.int64), np.array([v for _, v in found])
        order = np.lexsort((row_ids[rows], -values))[:limit]
        return rows[order], values[order]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        """The best ``limit`` A rows for every B title of one bounded piece of a block."""
        best: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        queries = right["b_key"].to_pylist() if left.num_rows else []
        titles = left["title_norm"].to_pylist()
        row_ids = left["row_id"].to_numpy()
        if queries:
            place: dict[str, int] = {}
            owners: list[list[int]] = []
            for i, t in enumerate(titles):
                if place.setdefault(t, len(owners)) == len(owners):
                    owners.append([])
                owners[place[t]].append(i)
            blocks = _blocks(list(place))
            for key in set(queries):
                best[key] = best_of(key, blocks, owners, row_ids)
        rows = [(k, y, i, v) for k, y in zip(queries, right["b_year"].to_pylist()) for i, v in zip(*best[k])]
        keys = [r[0] for r in rows]
        found = [titles[r[2]] for r in rows]
        return pa.table({
            "b_key": pa.array(keys, pa.string()),
            "b_year": pa.array([r[1] for r in rows], pa.int32()),
            "a_row_id": pa.array([int(row_ids[r[2]]) for r in rows], pa.int64()),
            "token_set": pa.array([float(r[3]) for r in rows], pa.float64()),
            "token_sort": pa.array(ratios([sort_tokens(k) for k in keys], [sort_tokens(t) for t in found])),
            "ratio": pa.array(ratios(keys, found)),
        })

    return score


def fuzzy_top_k(a: DataFrame, b: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """For every distinct (title, year) of B the best A rows of its block by token-set ratio.

    A block is cut on both sides into pieces of bounded rows and characters; each task scores one piece against one
    piece in memory and returns a few rows per B title, so pairs are never emitted and no block, however large, lands
    in one task. Within a piece an index from words to titles and the letters in common bound each score, and titles are
    compared in the order of their bounds until no bound reaches the k-th best score: exact, and few are compared.
    """
    k = settings.fuzzy_candidates
    block = ["first_letter", "release_year"]
    # of A rows with the same title and year only the k smallest ids can be among the best k
    left = keep_first(
        a.select(*block, "title_norm", "row_id"), [*block, "title_norm"], [F.col("row_id").asc()], n=k
    )
    right = (
        b.select("first_letter", F.col("title_norm").alias("b_key"), F.col("release_year").alias("b_year"))
        .distinct()
        .withColumn("release_year", F.explode(_near_years("b_year")))
    )
    def parts(side: DataFrame, title: str, rows: int, name: str) -> DataFrame:
        by_rows, by_chars = F.count(F.lit(1)) / rows, F.sum(F.length(title)) / settings.block_chars
        return side.groupBy(*block).agg(F.ceil(F.greatest(by_rows, by_chars)).cast("int").alias(name))

    pieces = parts(left, "title_norm", settings.block_rows_a, "pieces_a").join(
        parts(right, "b_key", settings.block_rows_b, "pieces_b"), block
    )

    def cut(side: DataFrame, key: Column, own: str, other: str) -> DataFrame:
        """Own piece by hash, and one copy for every piece of the other side."""
        return (
            attach(side, pieces, block, "pieces_a")
            .withColumn(own.replace("pieces", "piece"), F.pmod(F.xxhash64(key), F.col(own)).cast("int"))
            .withColumn(other.replace("pieces", "piece"), F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
            .drop("pieces_a", "pieces_b")
        )

    group = [*block, "piece_a", "piece_b"]
    # fixed partition number: the rows are few but the work per row is large, so the adaptive
    # planner must not merge the pieces by their byte size
    tasks = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut_a = cut(left, F.col("row_id"), "pieces_a", "pieces_b").repartition(tasks, *group)
    cut_b = cut(right, F.struct("b_key", "b_year"), "pieces_b", "pieces_a").repartition(tasks, *group)
    scored = cut_a.groupBy(*group).cogroup(cut_b.groupBy(*group)).applyInArrow(_score_block(k), _SCORES)
    return keep_first(
        scored, ["b_key", "b_year"], [F.col("token_set").desc(), F.col("a_row_id").asc()], n=k
    )


def fuzzy_candidates(a: DataFrame, b: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Every B row with its best A rows and the three title ratios of each pair."""
    rest = ["row_id", "ext_id", "title_display", "title_norm", "release_year", "runtime_min", "genre_set"]
    side_a = a.select(*[F.col(c).alias(f"a_{c}") for c in rest])
    side_b = b.select(*[F.col(c).alias(f"b_{c}") for c in rest])
    top = fuzzy_top_k(a, b, settings)
    pairs = top.join(side_a, "a_row_id").join(
        side_b,
        (F.col("b_key") == F.col("b_title_norm")) & (F.col("b_year") == F.col("b_release_year")),
    )
    return pairs.select(
        *[f"a_{c}" for c in rest],
        *[f"b_{c}" for c in rest],
        "token_set",
        "token_sort",
        "ratio",
    )


def match_fuzzy_blocked(a: DataFrame, b: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Candidates scored, resolved, and cut at the lowest class.

    The resolution prefers higher scores, so a pair below the cut never displaces one above it and
    the cut may come last, where it is a plain comparison on few rows.
    """
    pairs = fuzzy_candidates(a, b, settings)
    title_sim = F.greatest("token_set", "token_sort", "ratio")
    resolved = resolve_one_to_one(_audit(pairs, title_sim, "fuzzy_blocked", settings))
    return _with_status(resolved, settings).where(F.col("linkage_score") >= settings.score_manual)


LAYERS: dict[str, Callable[[DataFrame, DataFrame, Settings], DataFrame]] = {
    "exact": match_exact,
    "pm1": match_year_pm1,
    "fuzzy": match_fuzzy_blocked,
}


def without_matched(side: DataFrame, matched: DataFrame, column: str) -> DataFrame:
    """Rows not matched yet; weak matches count as matched too."""
    return side.join(matched.select(F.col(column).alias("row_id")), "row_id", "left_anti")


def linkage_cascade(
    a: DataFrame,
    b: DataFrame,
    stage: Stage,
    settings: Settings = DEFAULTS,
    layers: Sequence[str] = ("exact", "pm1", "fuzzy"),
) -> DataFrame:
    """All matches. ``stage`` writes a table and reads it back, so no layer is computed twice."""
    found: DataFrame | None = None
    for name in layers:
        layer = stage(LAYERS[name](a, b, settings), f"matches_{name}")
        found = layer if found is None else found.unionByName(layer)
        a, b = without_matched(a, layer, "a_row_id"), without_matched(b, layer, "b_row_id")
    return found


def one_to_one(matches: DataFrame) -> tuple[DataFrame, dict[str, Column], tuple[str, ...]]:
    """(matches with helper columns, violations, names of the helpers) for the write of all matches.

    Every row of either source is matched once at most, both ids are there, and scores lie between 0 and 100.
    """
    helpers = ("__again_a", "__again_b")
    flagged = matches
    for helper, key in zip(helpers, ("a_row_id", "b_row_id")):
        again = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("linkage_score"))) > 1
        flagged = flagged.withColumn(helper, again & F.col(key).isNotNull())
    checks = {
        "rows of A matched again": F.count_if("__again_a"),
        "rows of B matched again": F.count_if("__again_b"),
        "matches without an id": F.count_if(F.col("a_row_id").isNull() | F.col("b_row_id").isNull()),
        "scores out of range": F.count_if(~F.coalesce(F.col("linkage_score").between(0, 100), F.lit(False))),
    }
    return flagged, checks, helpers


def strong_only(matches: DataFrame) -> DataFrame:
    return matches.where(F.col("match_status") == "strong_match")


def review_set(matches: DataFrame, status: str) -> DataFrame:
    return matches.where(F.col("match_status") == status)


def equal_width_histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts over equal bins between the smallest and the largest value, empty bins included."""
    value = F.col(column)
    rows = df.where(value.isNotNull()).select(value.alias("v"))
    low, high = rows.agg(F.min("v")).scalar(), rows.agg(F.max("v")).scalar()
    width = (F.col("high") - F.col("low")) / bins
    slot = F.when(width > 0, F.least(F.floor((F.col("v") - F.col("low")) / width), F.lit(bins - 1)))
    counted = (
        rows.select("v", low.alias("low"), high.alias("high"))
        .groupBy(F.coalesce(slot, F.lit(0)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    edges = df.sparkSession.range(bins).select(
        F.col("id").cast("int").alias("bin"), low.alias("low"), high.alias("high")
    )
    return edges.join(counted, "bin", "left").select(
        "bin",
        (F.col("low") + F.col("bin") * width).alias("bin_start"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def linkage_score_histogram(matches: DataFrame, bins: int = 30) -> DataFrame:
    return equal_width_histogram(matches, "linkage_score", bins)
