"""Exact quantiles of any size of group.

``percentile`` keeps every distinct value of a group in one buffer. Here a bounded sketch only
chooses cut points near the wanted ranks; exact counts then say in which slice each rank lies, and
only the rows of those slices are sorted. Poor cut points would cost time, never exactness.

A sketch need not come out the same twice (a lost executor, another merge order), so it is read in
one place only: the slices carry their own edges, and everything after goes by those edges.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

ACCURACY = 10_000
SALTS = 64


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: dict[str, float],
    by: Sequence[str] = (),
    few_groups: bool = False,
) -> DataFrame:
    """``by`` columns plus one column per entry of ``probs`` (linear interpolation) and ``__n``.

    Missing values and groups with a NULL key are left out. ``few_groups``: the caller knows that the number of groups does
    not grow with the rows, as that of columns; the rows are then not shuffled.
    """
    by = list(by)
    names, levels = list(probs), list(probs.values())
    number = F.col(value).cast("double")
    rows = df.select(*by, number.alias("__v")).where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    for b in by:
        rows = rows.where(F.col(b).isNotNull())

    margin = 2.0 / ACCURACY
    cuts = sorted({min(1.0, max(0.0, p + d)) for p in levels for d in (-margin, margin)})
    sketch = F.percentile_approx("__v", cuts, F.lit(ACCURACY))
    marked = attach(rows, rows.groupBy(*by).agg(sketch.alias("__cuts")), by, "__cuts", few_groups)
    slot = sum((F.col("__v") > F.col("__cuts")[i]).cast("int") for i in range(len(cuts)))
    edges = ["__lo", "__hi"]  # NULL: open end
    sliced = marked.select(
        *by, "__v", F.get("__cuts", slot - 1).alias("__lo"), F.get("__cuts", slot).alias("__hi")
    )

    # a handful of slices per group: the exact position of each of them
    slices = sliced.groupBy(*by, *edges).agg(F.count(F.lit(1)).alias("__in"))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    running = group.orderBy(F.asc_nulls_first("__lo")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    placed = slices.select(
        *by,
        *edges,
        "__in",
        (F.sum("__in").over(running) - F.col("__in")).alias("__before"),
        F.sum("__in").over(group).alias("__n"),
    )
    last = F.col("__n") - 1
    wanted = F.array(*[
        F.struct(
            F.lit(i).alias("i"),
            F.lit(upper).alias("upper"),
            (F.least(F.floor(last * F.lit(float(p))) + upper, last) - F.col("__before")).alias("pos"),
            (last * F.lit(float(p)) % 1).alias("frac"),
            F.col("__n").alias("n"),
        )
        for i, p in enumerate(levels)
        for upper in (0, 1)
    ])
    inside = F.filter(wanted, lambda w: (w["pos"] >= 0) & (w["pos"] < F.col("__in")))
    ranges = (
        placed.withColumn("__wants", inside)
        .where(F.size("__wants") > 0)
        .groupBy(*by)
        .agg(F.collect_list(F.struct(*edges, "__wants")).alias("__ranges"))
    )

    # only values of the slices that hold a wanted rank go on, each distinct value once
    def holds(r: Column) -> Column:
        above = r["__lo"].isNull() | (F.col("__v") > r["__lo"])
        return above & (r["__hi"].isNull() | (F.col("__v") <= r["__hi"]))

    # a plain comparison drops nearly all rows before the array is looked into
    ends = [F.get("__ranges", F.lit(k)) for k in range(2 * len(levels))]
    in_some = reduce(or_, [r.isNotNull() & holds(r) for r in ends])
    near = attach(rows, ranges, by, "__ranges", few_groups).where(in_some).select(
        *by, "__v", F.explode(F.filter("__ranges", holds)).alias("r")
    )
    keys = [*by, *edges]
    tally = near.select(*by, "r.*", "__v").groupBy(*keys, "__v").agg(
        F.count(F.lit(1)).alias("__c"), F.any_value("__wants").alias("__wants")
    )
    upto = F.sum("__c").over(
        Window.partitionBy(*keys).orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    end = F.col("__upto")
    hit = F.filter("__wants", lambda w: (w["pos"] < end) & (w["pos"] >= end - F.col("__c")))
    hits = tally.withColumn("__upto", upto).select(*by, "__v", F.explode(hit).alias("w"))

    def at(i: int, upper: int) -> Column:
        return F.max(F.when((F.col("w.i") == i) & (F.col("w.upper") == upper), F.col("__v")))

    def level(i: int) -> Column:
        frac = F.max(F.when(F.col("w.i") == i, F.col("w.frac")))
        return at(i, 0) + (at(i, 1) - at(i, 0)) * frac

    return hits.groupBy(*by).agg(
        *[level(i).alias(name) for i, name in enumerate(names)], F.max("w.n").alias("__n")
    )


def attach(rows: DataFrame, facts: DataFrame, by: list[str], column: str, few_groups: bool = False) -> DataFrame:
    """Adds a column of facts per group; without groups it is one value and needs no join.

    With groups the facts are repeated ``SALTS`` times and the rows dealt over them by the partition
    they come from, so that a join by shuffle has no hot group. Small facts are broadcast by Spark itself, but where they are an
    aggregate it sees their size only when it has shuffled the rows; ``few_groups`` tells it before.
    """
    if not by:
        return rows.withColumn(column, facts.select(column).scalar())
    if few_groups:
        return rows.join(F.broadcast(facts), by)
    copies = facts.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("__salt", F.spark_partition_id() % SALTS).join(copies, [*by, "__salt"]).drop("__salt")


def mean_median_count(
    df: DataFrame, by: str, value: str, mean: str, median: str, count: str
) -> DataFrame:
    """Mean, exact median and number of the non-missing values per group."""
    rows = df.where(F.col(value).isNotNull() & F.col(by).isNotNull())
    basic = rows.groupBy(by).agg(F.avg(value).alias(mean), F.count(value).alias(count))
    middle = exact_quantiles(rows, value, {median: 0.5}, [by]).drop("__n")
    return basic.join(middle, by)
