"""Mixing sources to target weights by systematic sampling.

Every document of a source expects ``target / source size`` copies. In the order of size the expected
copies are summed up, one random offset per source is added, and a document is emitted once for every
integer that its part of the sum crosses. Neighbours have about the same size, so what a source gives
stays within about one document of its target.

Ranks come from range partitions: a source with a third of all rows, or one size shared by very many
documents, is spread over tasks by a hash. Only (partition, source) counts are summed in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from fusework.llm.textbatch import stored, word_count

# Fixed values of the mix: weights in turn over the sources by code point, share of all words, largest repetition.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_REPEAT = 2
SEED = 17


def ranked(df: DataFrame, order: Sequence[str], group: str, partitions: int | None = None) -> DataFrame:
    """Adds ``rank`` (long, from 1) within ``group`` in the order of (group, *order).

    ``df`` should be narrow: it is sorted by range and stored. Equal rows get their ranks in any order.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(group).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in order]]
    placed = stored(
        df.repartitionByRange(n, *keys).withColumn("part", F.spark_partition_id()), "ranged"
    )
    counts = placed.groupBy("part", group).agg(F.count(F.lit(1)).alias("rows"))
    # one row for each source in each partition at most: a few per partition, since partitions are ranges
    before = counts.select(
        F.col("part"), F.col(group).alias("of"),
        (F.sum("rows").over(W.partitionBy(group).orderBy("part")) - F.col("rows")).alias("before"),
    )
    local = F.row_number().over(W.partitionBy("part", group).orderBy(*keys))
    return (
        placed.withColumn("local", local)
        .join(before.withColumnRenamed("part", "at"), (F.col("part") == F.col("at")) & F.col(group).eqNullSafe(F.col("of")))
        .withColumn("rank", F.col("before") + F.col("local").cast("long"))
        .drop("part", "at", "of", "before", "local")
    )


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """source, source_size, target for every source of ``sizes`` (source, size).

    The excess over ``max_repeat`` times a source's size is dealt again by weight until none is above.
    One row per source: the loop runs over this table, a few aggregates a round.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # sorted by code point, NULL last, in ranges: no task holds all sources
    place = ranked(per_source.withColumn("all", F.lit(0)), ["source"], "all").drop("all")
    picked = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    table = stored(place.withColumn("weight", picked.cast("long")).drop("rank"), "sources")
    total = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        # the level is what one unit of weight gets; at a higher level only more sources stop
        full = F.col("weight") * F.lit(level) > F.lit(max_repeat) * F.col("source_size")
        n, kept, weight = table.agg(
            F.count(F.when(full, 1)),
            F.coalesce(F.sum(F.when(full, max_repeat * F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
        ).first()
        if n == capped or not weight:
            break
        capped, level = n, (total - kept) / weight
    target = F.least(F.col("weight") * F.lit(level), (max_repeat * F.col("source_size")).cast("double"))
    return table.select("source", "source_size", target.alias("target"))


def mix_sources(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                max_repeat: int = MAX_REPEAT, seed: int = SEED) -> DataFrame:
    """Copies of each document in the mix.

    ``sizes`` has key (any type), source (string, may be NULL: a source of its own) and size (long).
    Returns key, source, size, source_size, target and ``copies`` (0 to ``max_repeat``), one row for each
    input row. Rows of size 0 may get copies too; a source without any words has target 0 and none.
    Repeated rows are documents of their own. An empty table gives an empty table.
    """
    narrow = sizes.select("key", "source", F.coalesce(F.col("size"), F.lit(0)).cast("long").alias("size"))
    narrow = stored(narrow.withColumn("mixed", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("key").cast("string")))), "sizes")
    targets = source_targets(narrow, weights, share, max_repeat)
    placed = ranked(narrow, ["size", "mixed", "key"], "source")
    # the random offset of a source: 52 bits of a digest of seed and name
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("source"), F.lit("<null>"))))
    offset = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    each = targets.select(
        F.col("source").alias("of"), "source_size", "target", offset.alias("offset"),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("each"),
    )
    copies = F.floor(F.col("rank") * F.col("each") + F.col("offset")) - F.floor((F.col("rank") - 1) * F.col("each") + F.col("offset"))
    return (
        placed.join(each, F.col("source").eqNullSafe(F.col("of")))
        .select("key", "source", "size", "source_size", "target", copies.cast("long").alias("copies"))
    )


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mixed documents: each row of ``docs`` as often as the mix takes it, with the same columns.

    Rows equal in doc_id, source and text are interchangeable and share their copies in turn; all
    other columns, whatever their names, are carried along.
    """
    row = F.xxhash64("doc_id", "source", "text")
    keyed = docs.select(
        F.struct("*").alias("doc"), row.alias("row"), word_count(F.col("text")).alias("size"), "source", "doc_id"
    )
    copies = mix_sources(keyed.select(F.struct("doc_id", "row").alias("key"), "source", "size"))
    taken = (
        copies.groupBy(F.col("key.row").alias("row"))
        .agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("equal"))
        .where("copies > 0")
    )
    joined = keyed.select("doc", "row").join(taken, "row")
    single = joined.where("equal = 1").select("doc", "copies")
    # equal rows take turns: their places within the part of the table that they are stored in, and the rows of the parts before
    equal = stored(joined.where("equal > 1").withColumn("part", F.spark_partition_id()), "equal")
    local = F.row_number().over(W.partitionBy("row", "part").orderBy("row"))
    held = equal.groupBy("row", "part").agg(F.count(F.lit(1)).alias("held"))
    before = (F.sum("held").over(W.partitionBy("row").orderBy("part")) - F.col("held")).alias("before")
    several = equal.withColumn("local", local).join(held.select("row", "part", before), ["row", "part"])
    share = F.floor(F.col("copies") / F.col("equal"))
    several = several.withColumn("turn", F.col("before") + F.col("local")).select(
        "doc", (share + F.when(F.col("turn") <= F.col("copies") - share * F.col("equal"), 1).otherwise(0)).alias("copies")
    )
    return (
        single.unionByName(several).where("copies > 0")
        .withColumn("copy", F.explode(F.expr("sequence(1L, copies)"))).select("doc.*")
    )
