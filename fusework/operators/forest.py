"""Random forests that are grown and kept beside the data.

Spark ML grows all trees of a forest in the driver, and each of its passes shuffles the sums of every open node. Here rows go with
their bin numbers, one byte a feature. Nodes with many rows are split level by level from sums over all rows; a node of at most
``LOCAL_ROWS`` rows is grown to its leaves by one task. The driver holds the few nodes above them. The rules are those of Spark ML: bins
at most 32, Poisson draws, a random subset of the features for each node, the split with the largest gain, leaves where nothing is gained.

The gain is that of the variance, which for a target of 0 and 1 is half that of the Gini index, so one forest does both: the value
of a leaf is the mean of its rows, for two classes the share of the second.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from math import exp, factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fusework.session import StageStore, spread

Stage = Callable[[DataFrame, str], DataFrame]

BINS = 32
BIN_ROWS = 100_000  # from which the edges of the bins are taken; ten times what Spark ML takes
LOCAL_ROWS = 200_000  # of a node that one task grows
SLICE_NODES = 4096  # whose sums are held at a time
ROUND_BYTES = 8 << 20  # of nodes that rows are sent through at a time
MOST_TASKS = 1000
TINY = 1e-12  # a gain below this part of a node's squares is rounding
LEAF, LOCAL = -1, -2

_POISSON = np.cumsum([exp(-1) / factorial(k) for k in range(18)])


@dataclass
class Forest:
    """``top``: the nodes down to those that one task grew, the first ones the roots; ``units``: a stored row of nodes for each of these."""

    edges: list[np.ndarray]
    top: dict[str, np.ndarray]
    units: DataFrame
    trees: int
    mean: float


def bin_edges(values: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Edges halfway between neighbouring values, all of them or those nearest to equal numbers of rows."""
    found, counts = np.unique(values, return_counts=True)
    middle = (found[:-1] + found[1:]) / 2
    if len(middle) < bins:
        return middle
    upto = np.cumsum(counts)
    stride, edges, target = len(values) / bins, [], len(values) / bins
    for k in range(1, len(found)):
        if abs(upto[k - 1] - target) < abs(upto[k] - target):
            edges.append(middle[k - 1])
            target += stride
    return np.array(edges[: bins - 1])


def fit_forest(
    rows: DataFrame, key: str, features: Sequence[str], stage: Stage, name: str, trees: int, depth: int, seed: int, per_node: int
) -> Forest:
    """A forest over ``rows`` (key, target, features). Draws are hashes of the rows, so they survive any repartitioning."""
    features = list(features)
    drawn = rows.select(F.xxhash64(F.lit(seed), key, "target", *features).alias("draw"), F.col("target").alias("y"), *features)
    n, mean = rows.agg(F.count(F.lit(1)), F.avg("target")).first()
    share = min(1.0, BIN_ROWS / n)
    pool = drawn.where(F.pmod(F.xxhash64(F.lit(seed), "draw"), F.lit(1 << 30)) < int(share * (1 << 30))).select(*features).toArrow()
    edges = [bin_edges(pool[c].to_numpy()) for c in features]
    binned = spread(stage(_binned(drawn, features, edges, ["draw", "y"], "draw bigint, y double"), f"{name}_binned"))
    middle = float(round(mean))  # squares of what is left are small, and sums of whole numbers stay exact
    top = _top(binned, n, middle, len(features), trees, depth, seed, per_node)
    units = stage(_grown(binned, top, middle, len(features), trees, depth, seed, per_node), f"{name}_forest")
    return Forest(edges, top, units, trees, mean)


def predict_forest(forest: Forest, rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(target, value)``: the mean of the trees' leaves for each row; nodes are broadcast in rounds of bounded size."""
    spark, width, top, trees = rows.sparkSession, len(features), forest.top, forest.trees
    store = StageStore(spark)
    kept = _binned(rows.select("target", F.lit(0.0).alias("value"), *features), features, forest.edges, ["target", "value"], "target double, value double")
    votes = spread(store.save(kept, "votes"))
    sizes = forest.units.select("unit", NODE_BYTES * F.length("feature")).orderBy("unit").collect()
    # a tree that drew no rows tells the mean of all
    bare = np.setdiff1d(np.flatnonzero(top["feature"] == LOCAL), [u for u, _ in sizes])
    values = np.where(top["feature"] == LOCAL, 0.0, top["value"])
    values[bare] = forest.mean
    rounds, held = [], 0
    for unit, size in sizes:
        if rounds and held + size <= ROUND_BYTES:
            rounds[-1], held = (rounds[-1][0], unit), held + size
        else:
            rounds.append((unit, unit))
            held = size
    for k, (low, high) in enumerate(rounds or [(-1, -1)]):
        chosen = forest.units.where(F.col("unit").between(low, high)).toArrow().to_pylist()
        shared = spark.sparkContext.broadcast((values if k == 0 else np.zeros(len(values)), {r["unit"]: _nodes(r) for r in chosen}))
        share = 1 / trees if k == max(0, len(rounds) - 1) else 1.0

        def work(batches, shared=shared, share=share):
            for batch in batches:
                above, units = shared.value
                bins = _matrix(batch.column("bins"), width)
                at = _at_top(bins, top, trees)
                total = batch.column("value").to_numpy() + above[at].sum(1)
                for t in range(trees):
                    for unit in np.unique(at[:, t]).tolist():
                        if unit in units:
                            mine = np.flatnonzero(at[:, t] == unit)
                            feature, cut, left, value = units[unit]
                            total[mine] += value[_follow(bins[mine], np.zeros(len(mine), np.int64), feature, cut, left)]
                yield pa.RecordBatch.from_arrays([batch.column("bins"), batch.column("target"), pa.array(total * share)], ["bins", "target", "value"])

        votes = spread(store.save(votes.mapInArrow(work, "bins binary, target double, value double"), "votes"))
        shared.destroy()
    return votes.select("target", "value")


NODE_BYTES = 14


def _nodes(row: dict) -> tuple:
    return tuple(np.frombuffer(row[c], t) for c, t in (("feature", np.int8), ("cut", np.uint8), ("left", np.int32), ("value", np.float64)))


def _binned(rows: DataFrame, features: Sequence[str], edges: list[np.ndarray], keep: list[str], schema: str) -> DataFrame:
    """The columns ``keep`` and ``bins``, one byte a feature: how many edges its value is above."""

    def work(batches):
        for batch in batches:
            bins = np.stack([np.searchsorted(e, batch.column(c).to_numpy()).astype(np.uint8) for c, e in zip(features, edges)], 1)
            yield pa.RecordBatch.from_arrays([_binary(bins, np.arange(len(bins) + 1)), *(batch.column(c) for c in keep)], ["bins", *keep])

    return rows.mapInArrow(work, f"bins binary, {schema}")


def _binary(rows: np.ndarray, edges: np.ndarray) -> pa.Array:
    """The bytes of the rows between two edges, for each pair of neighbouring ones."""
    size = rows.itemsize * (rows.shape[1] if rows.ndim > 1 else 1)
    offsets = pa.py_buffer((edges * size).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width)


def _follow(bins: np.ndarray, at: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Where rows end up that stand at the nodes ``at``."""
    live = np.arange(len(at))
    while len(live):
        node = at[live]
        inner = feature[node] >= 0
        live, node = live[inner], node[inner]
        at[live] = left[node] + (bins[live, feature[node]] > cut[node])
    return at


def _at_top(bins: np.ndarray, top: dict[str, np.ndarray], trees: int) -> np.ndarray:
    """The last node above the units, of each row in each tree."""
    at = np.broadcast_to(np.arange(trees), (len(bins), trees))
    if len(top["feature"]) == trees:
        return at
    ends = [_follow(bins, at[:, t].copy(), top["feature"], top["cut"], top["left"]) for t in range(trees)]
    return np.stack(ends, 1)


def _weights(draw: np.ndarray, trees: int) -> np.ndarray:
    """How often each row is in the sample of each tree."""
    x = draw.view(np.uint64)[:, None] + np.arange(1, trees + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    return np.searchsorted(_POISSON, (x >> np.uint64(11)) / float(1 << 53), "right").astype(np.uint8)


def _best_splits(weight: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, ...]:
    """(feature's slot, cut, gain) of the best split of each node, from sums by node, slot and bin."""
    w, s = weight.cumsum(2), total.cumsum(2)
    whole, sums = w[:, :1, -1:], s[:, :1, -1:]
    w, s = w[:, :, :-1], s[:, :, :-1]
    rest = whole - w
    with np.errstate(divide="ignore", invalid="ignore"):
        score = np.where((w > 0) & (rest > 0), s * s / w + (sums - s) ** 2 / rest, -np.inf).reshape(len(w), -1)
        best = score.argmax(1)
        gain = score[np.arange(len(w)), best] - (sums * sums / whole).reshape(-1)
    return *np.divmod(best, w.shape[2]), gain


def _chosen(rng: np.random.Generator, nodes: int, width: int, per_node: int) -> np.ndarray:
    """Features of each node, drawn without repetition; of equal splits the first feature's counts."""
    return np.sort(rng.random((nodes, width)).argsort(1)[:, :per_node], 1)


def grow(bins: np.ndarray, weight: np.ndarray, y: np.ndarray, depth: int, per_node: int, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
    """(feature, cut, left, value) of all nodes; a row goes on to ``left``, or the node after it if its bin is above ``cut``."""
    width, node, size, base, levels = bins.shape[1], np.zeros(len(y), np.int64), 1, 0, []
    for level in range(depth + 1):
        w, s, q = (np.bincount(node, x, size) for x in (weight, weight * y, weight * y * y))
        feature, cut, left = np.full(size, LEAF, np.int8), np.zeros(size, np.uint8), np.zeros(size, np.int32)
        choice = _chosen(rng, size, width, per_node)
        mixed = np.flatnonzero(q - s * s / w > TINY * q) if level < depth else np.zeros(0, np.int64)
        for first in range(0, len(mixed), SLICE_NODES):
            some = mixed[first : first + SLICE_NODES]
            slot_of = np.full(size, -1)
            slot_of[some] = np.arange(len(some))
            mine = np.flatnonzero(slot_of[node] >= 0)
            own = bins[mine[:, None], choice[node[mine]]]
            cell = ((slot_of[node[mine]][:, None] * per_node + np.arange(per_node)) * BINS + own).ravel()
            shape = (len(some), per_node, BINS)
            sums = [np.bincount(cell, np.repeat(x[mine], per_node), np.prod(shape)).reshape(shape) for x in (weight, weight * y)]
            slot, at, gain = _best_splits(*sums)
            good = gain > TINY * q[some]
            feature[some[good]] = choice[some[good], slot[good]]
            cut[some[good]] = at[good]
        inner = np.flatnonzero(feature >= 0)
        left[inner] = base + size + 2 * np.arange(len(inner))
        levels.append((feature, cut, left, s / w))
        if not len(inner):
            break
        on = np.flatnonzero(feature[node] >= 0)
        place = np.full(size, -1)
        place[inner] = 2 * np.arange(len(inner))
        right = bins[on, feature[node[on]]] > cut[node[on]]
        bins, weight, y, node = bins[on], weight[on], y[on], place[node[on]] + right
        base, size = base + size, 2 * len(inner)
    return tuple(np.concatenate(c) for c in zip(*levels))


def _top(binned: DataFrame, n: int, middle: float, width: int, trees: int, depth: int, seed: int, per_node: int) -> dict[str, np.ndarray]:
    """Nodes of more than ``LOCAL_ROWS`` rows, split from sums over all rows, and their children."""
    top = {"feature": np.full(trees, LOCAL, np.int8), "cut": np.zeros(trees, np.uint8), "left": np.zeros(trees, np.int64), "value": np.zeros(trees)}
    large, level = np.arange(trees) if n > LOCAL_ROWS else np.zeros(0, np.int64), 0
    while len(large):
        rng = np.random.default_rng([seed, trees, level])
        choice = _chosen(rng, len(large), width, per_node)
        if level == depth:
            choice = choice[:, :1]
        wide = choice.shape[1]
        place = np.full(len(top["feature"]), -1)
        place[large] = np.arange(len(large))

        def sums(batches, top=top, place=place, choice=choice, wide=wide):
            cells = len(choice) * wide * BINS
            w, s, q = np.zeros(cells), np.zeros(cells), np.zeros(cells)
            for batch in batches:
                bins, y = _matrix(batch.column("bins"), width), batch.column("y").to_numpy() - middle
                weight, at = _weights(batch.column("draw").to_numpy(), trees), place[_at_top(bins, top, trees)]
                row, tree = np.nonzero((weight > 0) & (at >= 0))
                node, many, own = at[row, tree], weight[row, tree].astype(np.float64), y[row]
                for slot in range(wide):
                    cell = (node * wide + slot) * BINS + bins[row, choice[node, slot]]
                    w += np.bincount(cell, many, cells)
                    s += np.bincount(cell, many * own, cells)
                    q += np.bincount(cell, many * own * own, cells)
            used = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(x[used]) for x in (w, s, q))], ["cell", "w", "s", "q"])

        # as many sums as there are large nodes, times features and bins
        found = binned.mapInArrow(sums, "cell bigint, w double, s double, q double").groupBy("cell").agg(*[F.sum(c).alias(c) for c in "wsq"]).toArrow()
        w, s, q = (np.zeros(len(large) * wide * BINS) for _ in range(3))
        for x, c in ((w, "w"), (s, "s"), (q, "q")):
            x[found["cell"].to_numpy()] = found[c].to_numpy()
        w, s, q = (x.reshape(len(large), wide, BINS) for x in (w, s, q))
        whole, total, squares = (x[:, 0].sum(1) for x in (w, s, q))
        top["feature"][large] = LEAF
        top["value"][large] = middle + total / np.maximum(whole, 1)
        slot, cut, gain = _best_splits(w, s)
        good = (gain > TINY * squares) & (level < depth)
        split, nodes = np.flatnonzero(good), large[good]
        top["feature"][nodes], top["cut"][nodes] = choice[split, slot[split]], cut[split]
        top["left"][nodes] = len(top["feature"]) + 2 * np.arange(len(nodes))
        low = np.array([w[i, slot[i], : cut[i] + 1].sum() for i in split])
        rows = np.stack([low, whole[split] - low], 1).ravel()
        for c, x in (("feature", LOCAL), ("cut", 0), ("left", 0), ("value", 0.0)):
            top[c] = np.concatenate([top[c], np.full(2 * len(nodes), x, top[c].dtype)])
        children = np.arange(len(top["feature"]) - len(rows), len(top["feature"]))
        large, level = children[rows > LOCAL_ROWS], level + 1
    levels = np.zeros(len(top["feature"]), np.int32)
    for node in np.flatnonzero(top["feature"] >= 0):  # parents stand before their children
        levels[top["left"][node] : top["left"][node] + 2] = levels[node] + 1
    return {**top, "level": levels}


def _grown(binned: DataFrame, top: dict[str, np.ndarray], middle: float, width: int, trees: int, depth: int, seed: int, per_node: int) -> DataFrame:
    """(unit, feature, cut, left, value): the nodes below each local node of the top, as bytes; one task grows them from all its rows."""
    units = np.flatnonzero(top["feature"] == LOCAL)
    tasks = max(1, min(len(units), MOST_TASKS))
    number = np.zeros(len(top["feature"]), np.int64)
    number[units] = np.arange(len(units))

    def dealt(batches):
        for batch in batches:
            bins, y, draw = _matrix(batch.column("bins"), width), batch.column("y").to_numpy(), batch.column("draw").to_numpy()
            weight, at = _weights(draw, trees), _at_top(bins, top, trees)
            row, tree = np.nonzero((weight > 0) & (top["feature"][at] == LOCAL))
            unit = at[row, tree]
            order = np.argsort(unit, kind="stable")
            row, tree, unit = row[order], tree[order], unit[order]
            used, begin = np.unique(unit, return_index=True)
            edges = np.append(begin, len(unit))
            yield pa.RecordBatch.from_arrays(
                [pa.array(used), pa.array((number[used] % tasks).astype(np.int32)), _binary(bins[row], edges), _binary(weight[row, tree], edges), _binary(y[row], edges)],
                ["unit", "task", "bins", "weight", "y"],
            )

    def one(unit: int, held: list) -> pa.RecordBatch:
        bins = np.frombuffer(b"".join(x[0] for x in held), np.uint8).reshape(-1, width)
        weight = np.frombuffer(b"".join(x[1] for x in held), np.uint8).astype(np.float64)
        y = np.frombuffer(b"".join(x[2] for x in held), np.float64) - middle
        # rows come in any order; sums must not depend on it
        order = np.lexsort((weight, *bins.T, y))
        feature, cut, left, value = grow(
            bins[order], weight[order], y[order], depth - int(top["level"][unit]), per_node, np.random.default_rng([seed, unit])
        )
        columns = [feature, cut, left, value + middle]
        return pa.RecordBatch.from_arrays([pa.array([unit]), *(pa.array([x.tobytes()], pa.binary()) for x in columns)], ["unit", "feature", "cut", "left", "value"])

    def grown(batches):
        held, at = [], None
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["unit"] != at:
                    yield one(at, held)
                    held = []
                at = row["unit"]
                held.append((row["bins"], row["weight"], row["y"]))
        if held:
            yield one(at, held)

    rows = binned.mapInArrow(dealt, "unit bigint, task int, bins binary, weight binary, y binary")
    # a unit is in one task, and tasks have as many units
    placed = rows.repartitionById(tasks, F.col("task")).drop("task").sortWithinPartitions("unit")
    return placed.mapInArrow(grown, "unit bigint, feature binary, cut binary, left binary, value binary")
