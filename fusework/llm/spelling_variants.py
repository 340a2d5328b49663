"""Spelling variant grouping by a relational trie frontier.

The vocabulary is a trie kept as a distributed table of edges, with chains of single children merged into one
labelled edge. The frontier is a table of states (word, rest of the word still to read, node, edits). States
without an edit stand on the word's own path; joined with the edges there, each branch that leaves the path is an
edit: the edge's first letter replaces the word's, or is inserted before it. From then on a state follows the one
edge that spells what is left of its word, a join a level, until it ends on another word or nowhere.

A word of two halves has its only edit in one of them, so a trie of the words and one of the reversed words are
walked, each entered at the half of a word: an edit never branches near the root, where all letters go on.
Deletions are insertions seen from the other word; of two words that differ in one letter one finds the other.

A node is named by direction, depth and its prefix: by its letters if they are few, else by three hashes of them modulo
primes below 2^31. Each edge says which letters go on at its end, as bits of one number, so a state whose next letter
does not follow there is never written.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fusework.llm.language_id import code_points
from fusework.llm.textbatch import bounded_batches, discard, pieces, stored

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH = 7
RATIO = 10
NODE_STATES = 20_000  # states that meet at one copy of a node's edges

# Three primes and bases of the prefix hashes.
_PRIMES = (2147483647, 2147483629, 2147483587)
_BASES = (1103515245, 747796405, 277803737)

NODE = "uid bigint, a bigint, b bigint, next int"
PLAIN = 11  # letters of up to eight bits that a name has room for


def lower_ascii(run: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.lower(run) == run, run).otherwise(F.translate(run, upper, upper.lower()))


def letter_runs(docs: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """doc_id, run: every maximal run of letters with ``least`` code points or more, A-Z lower-cased. NULL has none."""
    runs = F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))
    return docs.select("doc_id", F.explode(runs).alias("run")).withColumn("run", lower_ascii(F.col("run")))


def count_words(runs: DataFrame, word: str = "word", least: int = LEAST_LENGTH, least_n: int = 2) -> DataFrame:
    """word, n of the distinct words with ``least`` code points and ``least_n`` occurrences or more."""
    counts = runs.where(F.length(word) >= least).groupBy(F.col(word).alias("word")).agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= least_n)


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    """The first ``n`` powers modulo a prime below 2^31, by doubling."""
    out = np.ones(1, np.uint64)
    while len(out) < n:
        step = np.uint64(pow(base, len(out), prime))
        out = np.concatenate([out, out * step % np.uint64(prime)])
    return out[:n]


def prefix_nodes(points: np.ndarray, starts: np.ndarray, lowest: np.ndarray, backward: int):
    """(word, a, b, next) for each prefix of ``lowest`` code points or more of each word; next is -1 at its end."""
    lengths = np.diff(starts)
    place = np.arange(len(points)) - np.repeat(starts[:-1], lengths)
    depths = lengths - lowest + 1
    word = np.repeat(np.arange(len(lengths)), depths)
    depth = np.arange(len(word)) - np.repeat(np.cumsum(depths) - depths, depths) + lowest[word]
    begin, end = starts[:-1][word], starts[:-1][word] + depth
    values = points.astype(np.uint64)
    wide = np.concatenate([[0], np.cumsum(points > 255)])
    short = (depth <= PLAIN) & (wide[end] == wide[begin])
    a, b = np.zeros(len(word), np.uint64), np.zeros(len(word), np.uint64)
    # the letters of a short prefix, eight bits each: seven in one number, four in the other
    for k in range(PLAIN):
        has = np.flatnonzero(short & (depth > k))
        part, shift = (a, 8 * k) if k < 7 else (b, 8 * (k - 7))
        part[has] |= values[begin[has] + k] << np.uint64(shift)
    hashed = np.flatnonzero(~short)
    if len(hashed):
        sums = []
        for prime, base in zip(_PRIMES, _BASES):
            p = np.uint64(prime)
            terms = (values + np.uint64(1)) * _powers(base, prime, int(lengths.max()))[place] % p
            total = np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64)])
            sums.append((total[end[hashed]] - total[begin[hashed]]) % p)
        a[hashed] = (sums[0] << np.uint64(31)) | sums[1]
        b[hashed] = sums[2]
    tag = (depth << 2).astype(np.uint64) | np.uint64(2 * backward) | (~short).astype(np.uint64)
    b = (b << np.uint64(32)) | tag
    following = np.append(points.astype(np.int64), -1)[np.minimum(end, len(points))]
    return word, a.astype(np.int64), b.astype(np.int64), np.where(depth == lengths[word], -1, following).astype(np.int32)


def _bit(code: Column) -> Column:
    """The bit that stands for a letter of this code; letters far apart may share one."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), (code % 64).cast("int"))


def _path_nodes(words: DataFrame) -> DataFrame:
    """The nodes on the path of each word in both tries, from the half on."""
    bounded_batches(words.sparkSession)

    def work(batches):
        for rows, data, offsets in pieces(batches, "word"):
            points, starts = code_points(data, offsets)
            uid = rows.column("uid").to_numpy()
            lengths = np.diff(starts)
            # a word one letter shorter enters at its own half
            for backward, lowest in ((0, (lengths - 1) // 2), (1, lengths // 2)):
                if backward:
                    points, starts = points[::-1], len(points) - starts[::-1]
                    uid, lowest = uid[::-1], lowest[::-1]
                word, a, b, following = prefix_nodes(points, starts, lowest, backward)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uid[word]), pa.array(a), pa.array(b), pa.array(following)], ["uid", "a", "b", "next"]
                )

    return words.select("uid", "word").mapInArrow(work, NODE)


def _trie(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges, states without an edit) of the tries of words (uid, word, n)."""
    nodes = stored(_path_nodes(words), "nodes")
    forks = F.min("next") != F.max("next")
    kept = nodes.groupBy("a", "b").agg(
        F.min("next").alias("low"), forks.alias("forks"), F.ceil(F.count(F.lit(1)) / F.lit(NODE_STATES)).cast("int").alias("copies"),
        F.bit_or(F.when(F.col("next") >= 0, _bit(F.col("next"))).otherwise(F.lit(0).cast("long"))).alias("goes"),
    ).where("forks OR low = -1").drop("low")
    on_path = nodes.drop("next").join(kept, ["a", "b"])
    back = F.shiftright("b", 1).bitwiseAND(1).cast("int")
    depth = F.shiftright(F.col("b").bitwiseAND(0xFFFFFFFF), 2).cast("int")
    paths = on_path.groupBy("uid", back.alias("back")).agg(
        F.sort_array(F.collect_list(F.struct(depth.alias("depth"), "a", "b", "forks", "copies", "goes"))).alias("path")
    )
    text = F.when(F.col("back") == 1, F.reverse("word")).otherwise(F.col("word"))
    paths = stored(paths.join(words, "uid").withColumn("text", text).withColumn("length", F.length("word")), "paths")

    half = F.floor(F.col("length") / 2)
    entry = F.when(F.col("back") == 1, F.col("length") - half).otherwise(half)
    states = paths.withColumn("entry", entry).select("uid", "word", "n", "text", "entry", F.explode("path").alias("at"))
    states = states.where((F.col("at.depth") >= F.col("entry")) & F.col("at.forks")).select(
        "uid", "word", "n", F.expr("substring(text, at.depth + 1)").alias("rest"), F.col("at.a").alias("a"), F.col("at.b").alias("b"),
        F.pmod("uid", F.col("at.copies")).cast("int").alias("copy"),
    )
    steps = F.arrays_zip(F.expr("slice(path, 1, size(path) - 1)").alias("up"), F.expr("slice(path, 2, size(path) - 1)").alias("down"))
    arcs = paths.where("size(path) > 1").select("uid", "word", "n", "text", "length", F.explode(steps).alias("s"))
    leaf = F.when(F.col("s.down.depth") == F.col("length"), F.struct("uid", "n", "word"))
    arcs = arcs.select(
        F.col("s.up.a").alias("a"), F.col("s.up.b").alias("b"), F.col("s.up.copies").alias("copies"),
        F.expr("substring(text, s.up.depth + 1, s.down.depth - s.up.depth)").alias("label"),
        F.col("s.down.a").alias("to_a"), F.col("s.down.b").alias("to_b"), F.col("s.down.goes").alias("goes"), leaf.alias("leaf"),
    )
    # all words that take an edge agree on its label and its end
    edges = arcs.groupBy("a", "b", F.substring("label", 1, 1).alias("c")).agg(
        *(F.min(x).alias(x) for x in ("label", "to_a", "to_b", "goes", "copies")), F.max("leaf").alias("leaf")
    )
    edges = edges.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
    edges = stored(edges.withColumn("tail", F.expr("substring(label, 2)")), "edges")
    states = stored(states.withColumns({"first": F.substring("rest", 1, 1), "more": F.expr("substring(rest, 2)")}), "states")
    discard(nodes, paths)
    return edges, states


def _lives(rest: Column) -> Column:
    """Whether a state at the end of an edge is a word's end or has a letter to go on by."""
    onward = _bit(F.ascii(F.substring(rest, 1, 1))).bitwiseAND(F.col("goes")) != 0
    return F.when(rest == "", F.col("leaf").isNotNull()).otherwise(onward)


def near_pairs(words: DataFrame) -> DataFrame:
    """uid, near_uid, near_n, near of all pairs of distinct words that differ by one code point, both ways, once each.

    ``words`` (uid, word, n) has distinct words of three code points or more. An empty table gives an empty one.
    """
    edges, states = _trie(words)
    first, rest, more, tail = F.col("first"), F.col("rest"), F.col("more"), F.col("tail")
    replaced = (F.col("c") > first) & (first != "") & F.startswith(more, tail)
    inserted = F.startswith(rest, tail)
    after = [F.expr("substring(more, 1 + length(tail))"), F.expr("substring(rest, 1 + length(tail))")]
    replaced, inserted = (x & _lives(y) for x, y in zip((replaced, inserted), after))
    edits = F.array(*[F.when(x, F.struct(y.alias("rest"))) for x, y in zip((replaced, inserted), after)])
    frontier = (
        states.join(edges, ["a", "b", "copy"])
        .where((F.col("c") != first) & (replaced | inserted))
        .withColumn("edit", F.explode(edits)).where("edit IS NOT NULL")
        .select("uid", "word", "n", F.col("edit.rest").alias("rest"), F.col("to_a").alias("a"), F.col("to_b").alias("b"), "leaf")
    )
    single = edges.where("copy = 0").drop("copy")
    found, level = [], 0
    while True:
        frontier = stored(frontier, f"frontier-{level}")
        if not level:
            discard(states)
        found.append(frontier.where("rest = '' AND leaf IS NOT NULL").select("uid", "word", "n", "leaf"))
        going = frontier.where("rest <> ''")
        if going.isEmpty():
            discard(edges)
            break
        frontier = (
            going.drop("leaf").withColumn("c", F.substring("rest", 1, 1)).join(single, ["a", "b", "c"]).where(F.startswith(rest, F.col("label")) & _lives(F.expr("substring(rest, length(label) + 1)")))
            .select("uid", "word", "n", F.expr("substring(rest, length(label) + 1)").alias("rest"),
                    F.col("to_a").alias("a"), F.col("to_b").alias("b"), "leaf")
        )
        level += 1
    hits = found[0]
    for more_hits in found[1:]:
        hits = hits.unionByName(more_hits)
    one = F.struct("uid", F.col("leaf.uid").alias("near_uid"), F.col("leaf.n").alias("near_n"), F.col("leaf.word").alias("near"))
    other = F.struct(F.col("leaf.uid").alias("uid"), F.col("uid").alias("near_uid"), F.col("n").alias("near_n"), F.col("word").alias("near"))
    return hits.select(F.explode(F.array(one, other)).alias("pair")).select("pair.*").dropDuplicates(["uid", "near_uid"])


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n, root of every row of ``words`` (word, n).

    ``words`` has one row a word, of three code points or more (others are near to nothing). A word's form is its
    near word of largest n, ties to the smallest in code-point order, if that n is at least ``ratio`` times its
    own; else NULL. root is the end of the forms' chain, the word itself where it has none. ``ratio`` is over 1,
    so that chains end. NULL words are dropped; other columns don't matter.
    """
    if ratio <= 1:
        raise ValueError("ratio must be over 1")
    rows = words.where("word IS NOT NULL").select("word", F.col("n").cast("long").alias("n"))
    words = stored(rows.withColumn("uid", F.monotonically_increasing_id()), "words")
    pairs = near_pairs(words.where(F.length("word") >= 3))
    best = pairs.groupBy("uid").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near", "near_n")).alias("best")
    )
    takes = F.col("best.near_n") >= ratio * F.col("n")
    table = stored(words.join(best, "uid", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(takes, F.col("best.near")).alias("form"), F.when(takes, F.col("best.near_n")).alias("form_n"),
    ), "forms")
    links = table.where("form IS NOT NULL").select(F.col("word").alias("root"), F.col("form").alias("onward"))
    # n grows by the ratio along a chain, so its length is at most a logarithm of the largest n
    ends = links.select(F.col("root").alias("word"), F.col("onward").alias("root"))
    step = 0
    while True:
        ahead = stored(ends.join(links, "root", "left"), f"roots-{step}")
        ends = ahead.select("word", F.coalesce("onward", "root").alias("root"))
        if ahead.where("onward IS NOT NULL").isEmpty():
            break
        step += 1
    return table.join(ends, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
