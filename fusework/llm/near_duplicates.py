"""N-gram Jaccard join with Bayesian candidate pruning.

Texts with the same set of word shingles are one class from the start; only one representative of a
class is compared. Representatives that share a band of MinHash values meet in blocks of bounded
size. Within a block MinHash values are compared a few at a time; a pair goes as soon as the
posterior probability of reaching the threshold, given its matches so far, falls below a tolerance.
What is left of a block is written as a forest, so a group of m near copies gives m rows and not
m * m. The trees' components are then compared once more, block against block, with the same pruning
and with the exact Jaccard similarity of the pairs that pass.

With 63 values in 21 bands of 3 a pair at the threshold 0.8 meets with probability 1 - 3e-7, and the
tolerance lets another 1e-6 go at most.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fusework.llm.textbatch import bounded_batches, mix, perhaps_in, pieces, shingle_hashes, span_hashes, stored, word_spans

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 21, 3
HASHES = BANDS * ROWS
STEP = 9  # MinHash values compared between two looks at the posterior
TOLERANCE = 1e-6
BLOCK = 512  # members of a block at most, on the average
BLOCK_SHINGLES = 200_000  # shingles of a block at most, on the average


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """(values compared, matches needed) after each step.

    With a uniform prior the posterior after m matches of n is Beta(m + 1, n - m + 1), whose
    probability above t is that of at most m successes in n + 1 draws with chance t.
    """
    needed = []
    for n in range(STEP, HASHES + 1, STEP):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        needed.append((n, m))
    return needed


def candidates(a: np.ndarray, b: np.ndarray, needed: list[tuple[int, int]]) -> np.ndarray:
    """Pairs (i, j) of rows of two signature matrices that no step of the pruning drops."""
    matches = np.zeros((len(a), len(b)), np.int16)
    for k in range(STEP):
        matches += a[:, k, None] == b[None, :, k]
    i, j = np.nonzero(matches >= needed[0][1])
    count = matches[i, j]
    for (n, least) in needed[1:]:
        if not len(i):
            break
        out = []
        for s in range(0, len(i), 100_000):
            x, y = i[s : s + 100_000], j[s : s + 100_000]
            out.append(count[s : s + 100_000] + (a[x, n - STEP : n] == b[y, n - STEP : n]).sum(1, dtype=np.int16))
        count = np.concatenate(out)
        keep = count >= least
        i, j, count = i[keep], j[keep], count[keep]
    return np.stack([i, j], 1)


def forest(pairs: np.ndarray, n: int) -> np.ndarray:
    """The smallest index that each of n nodes is linked to, directly or not."""
    label = np.arange(n)
    while len(pairs):
        low = np.minimum(label[pairs[:, 0]], label[pairs[:, 1]])
        new = label.copy()
        np.minimum.at(new, pairs[:, 0], low)
        np.minimum.at(new, pairs[:, 1], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def shared_counts(sets: list[np.ndarray], first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets ``first`` x ``second``; values in one set only cost nothing."""
    use = np.unique(np.concatenate([first, second]))
    place = np.full(len(sets), -1)
    place[use] = np.arange(len(use))
    values = np.concatenate([sets[k] for k in use])
    owner = np.repeat(np.arange(len(use)), [len(sets[k]) for k in use])
    _, ids, seen = np.unique(values, return_inverse=True, return_counts=True)
    keep = seen[ids] > 1
    _, ids = np.unique(ids[keep], return_inverse=True)
    owner = owner[keep]
    out = np.zeros((len(first), len(second)), np.float32)
    width = 4096
    order = np.argsort(ids, kind="stable")
    ids, owner = ids[order], owner[order]
    cuts = np.searchsorted(ids, np.arange(0, (ids[-1] if len(ids) else -1) + width + 1, width))
    for c, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
        if lo < hi:
            dense = np.zeros((len(use), width), np.float32)
            dense[owner[lo:hi], ids[lo:hi] - c * width] = 1
            out += dense[place[first]] @ dense[place[second]].T
    return out


def sketches(docs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The columns ``by``, doc_id, n_shingles, d1, d2 (a digest of the set of shingles), sig (MinHash values as bytes).

    A text of one to four words is one shingle; a text without words, or NULL, has none.
    """
    bounded_batches(docs.sparkSession)
    own = [*by, "doc_id"]
    keys = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in own)

    def work(batches):
        rng = np.random.default_rng(7)
        factor = rng.integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
        for rows, data, offsets in pieces(batches):
            hashes, owner, counts = distinct_shingles(data, offsets)
            n = rows.num_rows
            sig = np.full((n, HASHES), 0xFFFFFFFF, np.uint32)
            d1, d2 = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
            has = np.flatnonzero(counts)
            if len(has):
                at = (np.cumsum(counts) - counts)[has]
                for k in range(HASHES):
                    sig[has, k] = np.minimum.reduceat(((hashes * factor[k]) >> np.uint64(32)).astype(np.uint32), at)
                d1[has] = np.add.reduceat(mix(hashes), at)
                d2[has] = np.add.reduceat(mix(hashes ^ np.uint64(0x5BD1E995A5A5A5A5)), at)
            yield pa.RecordBatch.from_arrays(
                [*map(rows.column, own), pa.array(counts, pa.int64()), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
                 pa.array([r.tobytes() for r in sig], pa.binary())],
                [*own, "n_shingles", "d1", "d2", "sig"],
            )

    return docs.select(*own, "text").mapInArrow(work, f"{keys}, n_shingles bigint, d1 bigint, d2 bigint, sig binary")


def distinct_shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, row, number per row) of the distinct shingles of each row of a piece."""
    starts, ends, rows = word_spans(data, offsets)
    n = len(offsets) - 1
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(n, np.int64)
    hashes, owner = shingle_hashes(span_hashes(data, starts, ends), rows, n, SHINGLE)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    return hashes, owner, np.bincount(owner, minlength=n).astype(np.int64)


def components(edges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """node, root of all nodes of ``edges`` (a, b): root is the smallest node that a node is linked to.

    Each round links every node's larger neighbours, and the node, to its smallest neighbour, then the
    same the other way round, until all trees are stars. Rounds are few, as paths halve; each is a stored table.
    ``by`` names columns that the edges have too: graphs that have nothing to do with each other, in the same rounds.
    """
    by = list(by)
    now = stored(edges.where("a != b").select(*by, F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _all_stars(now, by):
        # large star: larger neighbours of a node go to its smallest neighbour or itself
        both = now.union(now.select(*by, F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(*by, "a").agg(F.min("b").alias("n")).select(*by, "a", F.least("a", "n").alias("m"))
        # an edge at most for each there was, so the repeated ones can wait for the distinct of the small star
        large = both.join(low, [*by, "a"]).where("b > a").select(*by, F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: a node and its smaller neighbours go to the smallest of them
        small_low = large.groupBy(*by, "a").agg(F.min("b").alias("m"))
        now = stored(
            large.join(small_low, [*by, "a"]).where("b != m").select(*by, F.col("b").alias("a"), F.col("m").alias("b"))
            .union(small_low.select(*by, "a", F.col("m").alias("b"))).where("a != b").distinct(), "edges",
        )
    ends = now.select(*by, F.col("a").alias("node"), F.col("b").alias("root"))
    return ends.union(now.select(*by, F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _all_stars(edges: DataFrame, by: list[str]) -> bool:
    """Whether each node has one smaller neighbour at most, and those that are one have none; what no round would change."""
    ends = edges.select(*by, F.col("a").alias("node"), F.lit(1).alias("down")).union(edges.select(*by, F.col("b").alias("node"), F.lit(0).alias("down")))
    nodes = ends.groupBy(*by, "node").agg(F.sum("down").alias("down"), F.min("down").alias("least"))
    return not nodes.agg(F.count_if(F.expr("down > 1 OR (down = 1 AND least = 0)"))).first()[0]


def _blocks(rows: DataFrame, count: str) -> DataFrame:
    """Each row once for each pair of blocks of its group that its block is part of: bi <= bj, side."""
    block = F.pmod(F.xxhash64("rep"), F.col(count)).alias("block")
    placed = rows.withColumn("block", block)
    cells = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col(count) - 1),
        lambda k: F.struct(F.least(k, F.col("block")).alias("bi"), F.greatest(k, F.col("block")).alias("bj")),
    )
    return placed.withColumn("cell", F.explode(cells)).select(*[c for c in placed.columns], "cell.bi", "cell.bj")


def _same(names: Sequence[str], key: tuple[pa.Scalar, ...], n: int) -> dict[str, pa.Array]:
    """Columns of n rows with the first values of a group's key."""
    return {c: pa.repeat(v, n) for c, v in zip(names, key)}


def _cell_edges(needed, by):
    """Candidate links of one cell as a forest: (a, b) rows, no more than members."""

    def work(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        bi, bj = key[-2].as_py(), key[-1].as_py()
        reps = table.column("rep").to_numpy()
        blocks = table.column("block").to_numpy()
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint32).reshape(len(reps), HASHES)
        first, second = np.flatnonzero(blocks == bi), np.flatnonzero(blocks == bj)
        found = []
        for s in range(0, len(first), BLOCK):
            for t in range(0, len(second), BLOCK):
                x, y = first[s : s + BLOCK], second[t : t + BLOCK]
                pairs = candidates(sig[x], sig[y], needed)
                found.append(np.stack([x[pairs[:, 0]], y[pairs[:, 1]]], 1))
        pairs = np.concatenate(found) if found else np.zeros((0, 2), int)
        order = np.argsort(reps, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        label = forest(rank[pairs[pairs[:, 0] != pairs[:, 1]]], len(reps))
        moved = np.flatnonzero(label != np.arange(len(reps)))
        return pa.table({**_same(by, key, len(moved)), "a": pa.array(reps[order][moved]), "b": pa.array(reps[order][label[moved]])})

    return work


def _cell_links(needed, threshold, by):
    """Verified links of one cell: rep, the smallest rep it is linked to here (or itself), number of links."""

    def work(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        bi, bj = key[-2].as_py(), key[-1].as_py()
        reps = table.column("rep").to_numpy()
        blocks = table.column("block").to_numpy()
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint32).reshape(len(reps), HASHES)
        sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        sizes = np.array([len(s) for s in sets])
        order = np.argsort(reps, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        first, second = np.flatnonzero(blocks == bi), np.flatnonzero(blocks == bj)
        links, found = np.zeros(len(reps), np.int64), []
        for s in range(0, len(first), BLOCK):
            for t in range(0, len(second), BLOCK):
                x, y = first[s : s + BLOCK], second[t : t + BLOCK]
                pairs = candidates(sig[x], sig[y], needed)
                pairs = np.stack([x[pairs[:, 0]], y[pairs[:, 1]]], 1)
                pairs = pairs[reps[pairs[:, 0]] < reps[pairs[:, 1]]] if bi == bj else pairs
                if not len(pairs):
                    continue
                u, pu = np.unique(pairs[:, 0], return_inverse=True)
                v, pv = np.unique(pairs[:, 1], return_inverse=True)
                both = shared_counts(sets, u, v)[pu, pv].astype(np.int64)
                union = sizes[pairs[:, 0]] + sizes[pairs[:, 1]] - both
                pairs = pairs[both >= np.ceil(threshold * union - 1e-9)]
                np.add.at(links, pairs[:, 0], 1)
                np.add.at(links, pairs[:, 1], 1)
                found.append(pairs)
        pairs = np.concatenate(found) if found else np.zeros((0, 2), int)
        label = forest(rank[pairs], len(reps))
        some = np.flatnonzero(links[order])
        return pa.table({**_same(by, key, len(some)), "rep": pa.array(reps[order][some]), "low": pa.array(reps[order][label[some]]), "links": pa.array(links[order][some])})

    return work


def shingle_sets(docs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The columns ``by``, rep, d1, shingles (sorted distinct 64-bit hashes as bytes) of ``docs`` (rep, text)."""
    own = [*by, "rep"]
    keys = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in own)

    def work(batches):
        for rows, data, offsets in pieces(batches):
            hashes, _, counts = distinct_shingles(data, offsets)
            ends = np.cumsum(counts)
            values = [hashes[e - c : e] for e, c in zip(ends, counts)]
            digest = np.array([mix(v).sum(dtype=np.uint64) for v in values], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*map(rows.column, own), pa.array(digest), pa.array([v.tobytes() for v in values], pa.binary())], [*own, "d1", "shingles"]
            )

    return docs.select(*own, "text").mapInArrow(work, f"{keys}, d1 bigint, shingles binary")


def near_duplicate_classes(
    docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, by: Sequence[str] = ()
) -> DataFrame:
    """doc_id, class_id, rep_id, n_links for every distinct doc_id of ``docs`` (doc_id bigint, text).

    ``rep_id`` is the smallest id with the same set of shingles. ``n_links`` counts the representatives
    of other sets at Jaccard similarity ``threshold`` or more. ``class_id`` is the smallest id that
    a document is linked to, over any number of links. A text without words is linked to nothing. Rows
    that repeat an id are one document; if their texts differ, the one whose shingles have the smallest
    digest counts. NULL ids take no part.

    ``by`` names columns, never NULL, of several sets of documents that are joined each by itself, but in the same
    Spark stages; they come first in the result.
    """
    by = list(by)
    types = "".join(f"{c} {docs.schema[c].dataType.simpleString()}, " for c in by)
    needed = least_matches(threshold, tolerance)
    docs = docs.where("doc_id IS NOT NULL")
    # one text for each id: where rows disagree, the one with the smallest digest
    sketch = sketches(docs, by).groupBy(*by, "doc_id").agg(F.min(F.struct("d1", "d2", "n_shingles", "sig")).alias("s"))
    sketch = stored(sketch.select(*by, "doc_id", "s.*"), "sketches")
    some = sketch.where("n_shingles > 0")
    sets = some.groupBy(*by, "d1", "d2", "n_shingles").agg(F.min("doc_id").alias("rep"))
    member = sketch.join(sets, [*by, "d1", "d2", "n_shingles"], "left")
    member = stored(member.select(*by, "doc_id", F.coalesce("rep", "doc_id").alias("rep"), "n_shingles", "d1", "d2", "sig"), "members")
    reps = member.where("doc_id = rep AND n_shingles > 0").select(*by, "rep", "n_shingles", "d1", "d2", "sig")

    # bands: the key is a hash of the band's number and bytes
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda k: F.xxhash64(k, F.substring(F.col("sig"), k * (4 * ROWS) + 1, F.lit(4 * ROWS))),
    )
    keys = reps.select(*by, "rep", F.explode(bands).alias("band"))
    full = keys.groupBy(*by, "band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = keys.join(full, [*by, "band"]).withColumn("blocks", F.ceil(F.col("n") / BLOCK))
    met = buckets.join(reps.select(*by, "rep", "sig"), [*by, "rep"])
    cells = _blocks(met, "blocks").select(*by, "band", "bi", "bj", "rep", "block", "sig")
    edges = cells.groupBy(*by, "band", "bi", "bj").applyInArrow(_cell_edges(needed, by), f"{types}a bigint, b bigint")
    groups = stored(components(edges, by), "groups").withColumnRenamed("node", "rep")

    # the members of each group once more, with their shingles
    grouped = groups.join(reps, [*by, "rep"]).select(*by, "root", "rep", "n_shingles", "d1", "sig")
    sizes = grouped.groupBy(*by, "root").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).alias("blocks")
    )
    # most texts are in no group; they are told before the shuffle of the join
    texts = perhaps_in(docs.select(*by, F.col("doc_id").alias("rep"), "text"), groups, [*by, "rep"], groups.count()).where("perhaps").drop("perhaps")
    texts = texts.join(grouped.select(*by, "rep"), [*by, "rep"], "left_semi")
    known = shingle_sets(texts, by).dropDuplicates([*by, "rep", "d1"])
    verified = grouped.join(sizes, [*by, "root"]).join(known, [*by, "rep", "d1"])
    pairs = _blocks(verified, "blocks").select(*by, "root", "bi", "bj", "rep", "block", "sig", "shingles")
    links = stored(
        pairs.groupBy(*by, "root", "bi", "bj").applyInArrow(_cell_links(needed, threshold, by), f"{types}rep bigint, low bigint, links bigint"), "links"
    )
    classes = components(links.select(*by, F.col("rep").alias("a"), F.col("low").alias("b")), by).withColumnRenamed("node", "rep")
    counts = links.groupBy(*by, "rep").agg(F.sum("links").alias("links"))
    per_rep = counts.join(classes, [*by, "rep"]).select(*by, "rep", "root", "links")
    return member.join(per_rep, [*by, "rep"], "left").select(
        *by, "doc_id", F.coalesce("root", "rep").alias("class_id"), F.col("rep").alias("rep_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
    )


def drop_near_duplicates(docs: DataFrame, whole: str | None = None) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its class, with all their columns.

    ``whole`` names a column with the texts before lines were cut out of them: an id must be the smallest
    of its class by these texts too, and the column is dropped. Rows with a NULL id stay, and so do texts
    without words. Rows that repeat a kept id stay too.
    """
    columns = ["text", *([whole] if whole else [])]
    # both texts of a document in one join: half the stages, whose exchanges and tasks the driver keeps account of
    texts = [docs.select(F.lit(k).alias("side"), F.col("doc_id").cast("long").alias("doc_id"), F.col(c).alias("text")) for k, c in enumerate(columns)]
    classes = near_duplicate_classes(reduce(DataFrame.union, texts), by=["side"])
    # every id that is not NULL has a class by each of its texts
    gone = stored(classes.where("doc_id != class_id").select(F.col("doc_id").alias("id")).distinct(), "gone")
    if whole:
        docs = docs.drop(whole)
    boxed = perhaps_in(docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("id")), gone, ["id"], gone.count())
    # texts that surely stay are not shuffled
    kept = boxed.where("perhaps AND id IS NOT NULL").join(gone, "id", "left_anti").select("doc")
    return kept.union(boxed.where("NOT perhaps OR id IS NULL").select("doc")).select("doc.*")
